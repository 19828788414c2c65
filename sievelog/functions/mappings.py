"""Lookup tables of the label model. They must equal the published mapping."""

from __future__ import annotations

ROLE_TACTICS: dict[str, list[str]] = {
    "Reconnaissance Host": ["TA0043", "TA0007"],
    "Reconnaissance Target": ["TA0043", "TA0007"],
    "Recon Hardware": ["TA0043", "TA0007"],
    "Recon Service": ["TA0043", "TA0007"],
    "Network Scanner": ["TA0007"],
    "Exploiting Host": ["TA0001", "TA0002"],
    "Exploiting Target": ["TA0001"],
    "Exploited Hardware": ["TA0001"],
    "Exploited Service": ["TA0001"],
    "Phishing Site": ["TA0001"],
    "Phishing Email": ["TA0001"],
    "Phishing Hardware": ["TA0001"],
    "Phishing Service": ["TA0001"],
    "Phished Host": ["TA0001"],
    "Phished User": ["TA0001"],
    "Staging Host": ["TA0002", "TA0003"],
    "Staging Target": ["TA0002", "TA0003"],
    "Staging Hardware": ["TA0002", "TA0003"],
    "Staging Service": ["TA0002", "TA0003"],
    "Malicious File": ["TA0002"],
    "Malicious Email": ["TA0001", "TA0002"],
    "C2 Server": ["TA0011"],
    "Bot": ["TA0011"],
    "Botnet Hardware": ["TA0011"],
    "Botnet Service": ["TA0011"],
    "Exfiltration Host": ["TA0010", "TA0009"],
    "Exfiltration Target": ["TA0010"],
    "Exfiltration Hardware": ["TA0010"],
    "Exfiltration Service": ["TA0010"],
    "Disruption Host": ["TA0040"],
    "Disruption Target": ["TA0040"],
    "Disruption Hardware": ["TA0040"],
    "Disruption Service": ["TA0040"],
    "Disrupted Service": ["TA0040"],
    "Ransomware Source": ["TA0001", "TA0040"],
    "Ransomware Target": ["TA0040"],
    "Ransomware Malware": ["TA0002", "TA0040"],
    "Ransomware Hardware": ["TA0040"],
    "Ransomware Service": ["TA0040"],
    "Ransomware User": ["TA0040"],
    "Financial Exploit Target": ["TA0040"],
    "Financial Exploiting File": ["TA0002", "TA0040"],
    "Financial Exploiting Hardware": ["TA0040"],
    "Financial Exploiting Host": ["TA0040"],
    "Financial Exploiting Service": ["TA0040"],
    "Financial Exploiting User": ["TA0040"],
    "Financial Account": ["TA0009"],
    "SCADA Exploit Target": ["TA0040"],
    "SCADA Exploiting File": ["TA0002", "TA0040"],
    "SCADA Exploiting Hardware": ["TA0040"],
    "SCADA Exploiting Host": ["TA0040"],
    "SCADA Exploiting Service": ["TA0040"],
    "SCADA Exploiting User": ["TA0040"],
    "Suspicious User": [],
}

ROLE_TECHNIQUES: dict[str, list[str]] = {
    "C2 Server": ["T1071", "T1095"],
    "Bot": ["T1071"],
    "Botnet Hardware": ["T1071"],
    "Botnet Service": ["T1071"],
    "Network Scanner": ["T1046"],
    "Reconnaissance Host": ["T1595"],
    "Reconnaissance Target": ["T1595"],
    "Recon Hardware": ["T1595"],
    "Recon Service": ["T1595"],
    "Phishing Site": ["T1566"],
    "Phishing Email": ["T1566"],
    "Phishing Hardware": ["T1566"],
    "Phishing Service": ["T1566"],
    "Phished Host": ["T1566"],
    "Phished User": ["T1566"],
    "Malicious Email": ["T1566"],
    "Malicious File": ["T1204"],
    "Exploiting Host": ["T1190"],
    "Exploiting Target": ["T1190"],
    "Exploited Hardware": ["T1190"],
    "Exploited Service": ["T1190"],
    "Exfiltration Host": ["T1041"],
    "Exfiltration Target": ["T1041"],
    "Exfiltration Hardware": ["T1041"],
    "Exfiltration Service": ["T1041"],
    "Ransomware Source": ["T1486"],
    "Ransomware Target": ["T1486"],
    "Ransomware Malware": ["T1486"],
    "Ransomware Hardware": ["T1486"],
    "Ransomware Service": ["T1486"],
    "Ransomware User": ["T1486"],
    "Disruption Host": ["T1499"],
    "Disruption Target": ["T1499"],
    "Disruption Hardware": ["T1499"],
    "Disruption Service": ["T1499"],
    "Staging Host": ["T1105"],
    "Staging Target": ["T1105"],
    "Staging Hardware": ["T1105"],
    "Staging Service": ["T1105"],
}

MO_TACTICS: dict[str, list[str]] = {
    "Data Theft": ["TA0009", "TA0010"],
    "Ransomware": ["TA0001", "TA0002", "TA0040"],
    "Credential Theft": ["TA0006"],
    "Lateral Movement": ["TA0008"],
    "Reconnaissance": ["TA0043", "TA0007"],
    "Privilege Escalation": ["TA0004"],
    "Command and Control": ["TA0011"],
    "Exfiltration": ["TA0010"],
    "Initial Access": ["TA0001"],
    "Persistence": ["TA0003"],
    "Defense Evasion": ["TA0005"],
    "Discovery": ["TA0007"],
    "Collection": ["TA0009"],
    "Execution": ["TA0002"],
    "Impact": ["TA0040"],
}

MO_TECHNIQUES: dict[str, list[str]] = {
    "Data Theft": ["T1041", "T1567"],
    "Ransomware": ["T1486"],
    "Credential Theft": ["T1003", "T1110"],
    "Lateral Movement": ["T1021"],
    "Reconnaissance": ["T1595", "T1046"],
    "Privilege Escalation": ["T1068"],
    "Command and Control": ["T1071"],
    "Exfiltration": ["T1041"],
    "Initial Access": ["T1190", "T1566"],
    "Persistence": ["T1098"],
    "Defense Evasion": ["T1562"],
    "Discovery": ["T1018", "T1046"],
    "Collection": ["T1005"],
    "Execution": ["T1059"],
    "Impact": ["T1486", "T1499"],
}

MO_LIFECYCLE: dict[str, list[str]] = {
    "Data Theft": ["complete-mission"],
    "Ransomware": ["complete-mission"],
    "Credential Theft": ["credential-access"],
    "Lateral Movement": ["move-laterally"],
    "Reconnaissance": ["initial-reconnaissance"],
    "Privilege Escalation": ["escalate-privilege"],
    "Command and Control": ["maintain-persistence"],
    "Exfiltration": ["complete-mission"],
    "Initial Access": ["initial-compromise"],
    "Persistence": ["maintain-persistence"],
    "Defense Evasion": ["move-laterally"],
    "Discovery": ["internal-reconnaissance"],
    "Collection": ["complete-mission"],
    "Execution": ["establish-foothold"],
    "Impact": ["complete-mission"],
    "Phishing": ["initial-compromise"],
}

ROLE_LIFECYCLE: dict[str, list[str]] = {
    "Exploiting Host": ["initial-compromise"],
    "Exploiting Target": ["initial-compromise"],
    "Staging Host": ["establish-foothold"],
    "Staging Target": ["establish-foothold"],
    "Exfiltration Host": ["complete-mission"],
    "Exfiltration Target": ["complete-mission"],
    "C2 Server": ["maintain-persistence"],
    "Bot": ["maintain-persistence"],
    "Reconnaissance Host": ["initial-reconnaissance"],
    "Reconnaissance Target": ["initial-reconnaissance"],
    "Disruption Host": ["complete-mission"],
    "Disruption Target": ["complete-mission"],
    "Phishing Site": ["initial-compromise"],
    "Phished User": ["initial-compromise"],
    "Phished Host": ["initial-compromise"],
    "Ransomware Malware": ["complete-mission"],
    "Ransomware Target": ["complete-mission"],
    "Ransomware Source": ["complete-mission"],
    "Policy Violation User": ["policy-violation"],
    "Policy Violation Target": ["policy-violation"],
    "Policy Violation Host": ["policy-violation"],
    "Suspicious User": ["unknown"],
    "Malicious File": ["establish-foothold"],
    "Malicious Email": ["initial-compromise"],
}

STATUS_DISPOSITION: dict[str, list[str]] = {
    "Disrupted": ["confirmed-malicious"],
    "Investigating": ["confirmed-malicious"],
    "Resolved": ["confirmed-malicious"],
    "Dismissed": ["dismissed"],
    "False Positive": ["false-positive"],
    "Unprocessed": ["automated"],
}

MESSAGE_EDGE: dict[str, list[str]] = {
    "firewall_action": ["NETWORK_FLOW"],
    "flow": ["NETWORK_FLOW"],
    "dns_event": ["DNS_RESOLVE"],
    "account_logon": ["LOGON"],
    "security_audit_event": ["AUDIT_EVENT"],
    "management_message": ["SYSTEM_EVENT"],
    "java_error": ["SYSTEM_EVENT"],
    "AssumeRole": ["AUTH"],
    "DescribeInstances": ["API_CALL"],
    "DescribeInstanceStatus": ["API_CALL"],
    "DescribeAccountAttributes": ["API_CALL"],
    "GetTopicAttributes": ["API_CALL"],
    "ListTagsForResource": ["API_CALL"],
    "ListClusters": ["API_CALL"],
    "DescribeVolumes": ["API_CALL"],
    "DescribeLoadBalancers": ["API_CALL"],
    "GenerateDataKey": ["CRYPTO_OP"],
    "GetBucketAcl": ["API_CALL"],
    "audit_log": ["AUDIT_EVENT"],
    "4656": ["FILE_ACCESS"],
    "4658": ["HANDLE_CLOSE"],
    "4690": ["HANDLE_DUP"],
    "4793": ["ACCOUNT_MGMT"],
    "4799": ["GROUP_MGMT"],
}


def map_rows(table: dict[str, list[str]]) -> list[tuple[str, int, str]]:
    """(key, position, value) rows."""
    return [(k, i, v) for k, values in table.items() for i, v in enumerate(values)]
