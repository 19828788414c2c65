"""Terms and domains that are public knowledge and never sensitive. Fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import detectors as D

PROTOCOL_TERMS = ("tcp", "udp", "icmp", "http", "https", "dns", "smtp", "smb", "ldap", "ssh", "ftp", "snmp", "ntp", "dhcp", "arp", "bgp", "ospf", "rip", "tls", "ssl", "rdp", "vnc", "telnet", "kerberos", "sip", "rtsp", "pop3", "imap", "tftp", "syslog", "radius", "tacacs")
VENDOR_TERMS = (
    "cisco", "microsoft", "windows", "linux", "vmware", "amazon", "aws", "azure", "google", "fortinet", "palo alto", "checkpoint", "crowdstrike", "splunk", "elastic", "meraki", "juniper", "sophos", "sentinel", "defender", "cloudtrail", "guardduty", "securityhub",
    "vcenter", "esxi", "datto", "limacharlie", "dnsmasq", "vpxd-main", "eam-main", "eam-api", "winlogbeat", "fortigate", "apache", "nginx", "iis", "oracle", "mysql", "postgresql", "mongodb", "redis", "docker", "kubernetes",
)
WINDOWS_TERMS = (
    "security", "system", "application", "eventdata", "eventid", "level", "task", "opcode", "keywords", "channel", "provider", "correlation", "execution", "logon", "logoff", "audit", "privilege", "process", "object", "handle", "token", "account", "microsoft-windows-security-auditing",
    "winlogbeat", "sec_login", "login success", "login failure", "users", "local", "localhost", "administrators", "domain users", "domain admins", "backup operators", "authenticated users", "everyone",
)
FIREWALL_TERMS = ("asa", "deny", "permit", "teardown", "built", "outside", "inside", "dmz", "dmz-1", "dmz-2", "management", "access-group", "outside_access_in")
FRAMEWORK_TERMS = ("nist", "cis", "cmmc", "pci", "soc2", "iso27001", "csf", "hipaa", "gdpr", "ccpa", "d3fend")
SYSLOG_TERMS = ("local0", "local1", "local2", "local3", "local4", "local5", "local6", "local7", "kern", "user", "mail", "daemon", "auth", "syslog", "lpr", "news", "uucp", "cron", "authpriv", "informational", "notice", "warning", "error", "critical", "alert", "emergency", "debug")
CLOUD_TERMS = (
    "ec2", "s3", "iam", "lambda", "rds", "dynamodb", "cloudwatch", "cloudformation", "elasticache", "ecs", "eks", "fargate", "sqs", "sns", "ses", "route53", "vpc", "elb", "alb", "nlb", "trustedadvisor", "config", "inspector", "guardduty", "securityhub", "waf", "shield", "kms", "secretsmanager",
    "ssm", "codepipeline", "codebuild", "codedeploy",
)
PUBLIC_DOMAINS = (
    "google.com", "amazonaws.com", "aws.amazon.com", "microsoft.com", "github.com", "cloudfront.net", "azure.com", "office365.com", "office.com", "live.com", "outlook.com", "windows.net", "akamai.net", "akamaized.net", "cloudflare.com", "fastly.net", "facebook.com", "twitter.com", "linkedin.com",
    "apple.com", "ubuntu.com", "debian.org", "centos.org", "redhat.com", "docker.io", "docker.com", "npmjs.org", "pypi.org", "mozilla.org", "mozilla.com", "firefox.com", "crl.microsoft.com", "ocsp.digicert.com", "pki.goog", "update.microsoft.com", "download.microsoft.com",
    "example.com", "example.net", "example.org", "example.internal", "sni.global.fastly.net",
)
TERMS = PROTOCOL_TERMS + VENDOR_TERMS + WINDOWS_TERMS + FIREWALL_TERMS + FRAMEWORK_TERMS + SYSLOG_TERMS + CLOUD_TERMS

#: Accounts and domains of operating systems, which name nobody.
SAFE_USERS = ("SYSTEM", "LOCAL SERVICE", "NETWORK SERVICE", "ANONYMOUS LOGON", "DWM-1", "DWM-2", "DWM-3", "UMFD-0", "UMFD-1", "UMFD-2", "-", "", "root", "nobody", "daemon", "bin", "sys", "adm")
SAFE_DOMAINS = ("NT AUTHORITY", "BUILTIN", "NT SERVICE", "Window Manager", "Font Driver Host", "IIS APPPOOL", "WORKGROUP")


def is_public_domain(name: Column, domains: tuple[str, ...] = PUBLIC_DOMAINS) -> Column:
    """One of the domains or a name below one."""
    return D.public_domain(name, list(domains))


def is_allowed(term: Column, loose_ids: bool = False, terms: tuple[str, ...] = TERMS, domains: tuple[str, ...] = PUBLIC_DOMAINS) -> Column:
    """Terms of the lists, public domains and what is below them, and framework ids. ``loose_ids``: everything of up to ten
    characters that begins like a framework id."""
    low = F.lower(F.trim(term))
    ids = D.is_framework_id(low) | ((F.length(low) <= 10) & F.upper(low).rlike("^(?:T1|T2|TA0)") if loose_ids else F.lit(False))
    return low.isin(*terms) | is_public_domain(low, domains) | ids


def is_safe_user(name: Column) -> Column:
    return F.upper(F.trim(name)).isin(*[u.upper() for u in SAFE_USERS])


def is_safe_domain(name: Column) -> Column:
    return F.trim(name).isin(*SAFE_DOMAINS)
