"""Patterns of the value detectors (fixed values of the data model) and predicates on single values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"\b(?:{_OCTET}\.){{3}}{_OCTET}\b"
IPV4_PORT = rf"\b((?:{_OCTET}\.){{3}}{_OCTET})([/:](\d{{1,5}}))\b"
RFC1918 = r"(?:10\.\d{1,3}\.\d{1,3}\.\d{1,3}|172\.(?:1[6-9]|2\d|3[01])\.\d{1,3}\.\d{1,3}|192\.168\.\d{1,3}\.\d{1,3})"
TEST_NET = r"(?:192\.0\.2\.\d{1,3}|198\.51\.100\.\d{1,3}|203\.0\.113\.\d{1,3})"
LOOPBACK = r"127\.\d{1,3}\.\d{1,3}\.\d{1,3}"
FQDN = r"\b(?:[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?\.){2,}[a-zA-Z]{2,}\b"
HEX_IP = r"\bIP-([0-9A-Fa-f]{8})\b"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
SID = r"\bS-1-(?:0|1|2|3|5)-(?:\d+-){1,14}\d+\b"
DOMAIN_USER = r"\b([A-Z][A-Z0-9-]+)\\([A-Za-z0-9._-]+)\b"
MACHINE = r"\b[A-Z][A-Z0-9-]{2,30}\$(?=\s|$|[^A-Za-z0-9])"
ACCOUNT_ID = r"(?<!\d)\d{12}(?!\d)"
ARN = r"\barn:aws(?:-[a-z]+)?:[a-z0-9-]+(?::[a-z0-9-]*){2}:\S+\b"
ADVISOR = r"\bTrustedAdvisor_(\d{12})_([a-f0-9-]{36})\b"
ORG_DOMAIN = r"(?i)([A-Za-z][A-Za-z0-9 ]*?)\s*\(([a-z0-9-]+\.[a-z0-9.-]+\.[a-z]{2,})\)"
IFACE_IP = r"(src|dst)\s+([a-zA-Z0-9_-]+):((?:\d{1,3}\.){3}\d{1,3})/(\d+)"
ORIGINAL_ADDRESS = r"Original\s+Address=((?:\d{1,3}\.){3}\d{1,3})"
FLOW_IP = r"(src|dst)=((?:\d{1,3}\.){3}\d{1,3})"
HEADER_HOST = r"(?m)^(<\d+>1?\s*\d{4}-\d{2}-\d{2}T[\d:.+-]+\s+)(\S+)(\s+)"
CSV_HEADER_HOST = r"^(<\d+>\w{3}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2}\s+)(\S+)(\s+)"
UNC_SERVER = r"(\\\\)([A-Za-z0-9._-]+)"
SHARED_NET = r"100\.(?:6[4-9]|[7-9]\d|1[01]\d|12[0-7])\.\d{1,3}\.\d{1,3}"
DNS_REPLY = r"(reply|query)\s+(\S+)\s+is\s+((?:\d{1,3}\.){3}\d{1,3})"
XML_VALUE = r"(?i)<(TargetUserName|SubjectUserName|IpAddress|WorkstationName|Computer|TargetDomainName|SubjectDomainName|TargetServerName|CallerProcessName|ObjectName|TargetLogonId|SubjectLogonId)>([^<]*)</\1>"
XML_COMPUTER = r"(?i)<Computer>([^<]+)</Computer>"
AGENT_NAME = r'"name"\s*:\s*"([^"]+)"'
UUID = r"(?i)\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b"
OWN_TOKEN = r"(?i)^(?:HOST-\d+|USER-\d+|ORG-\d+|CRED-\d+|MACHINE-\d+\$|AGENT-\d+|REDACTED-[A-Z]+-\d+|domain-\d+\.example\.net|host-\d+\.example\.internal|user-\d+@example\.net|S-1-5-21-1000000000-2000000000-3000000000-\d+|arn:aws:iam::\d+:sanitized/\d+)$"


def customer_domains(domains: list[str]) -> str:
    """Pattern of the domains and their subdomains; of none: matches nothing."""
    escaped = [d.replace(".", r"\.").replace("-", r"\-") for d in domains]
    return rf"(?i)\b[\w.-]*(?:{'|'.join(escaped)})\b" if escaped else r"(?!)"


def _is(column: Column, pattern: str) -> Column:
    return column.rlike(f"^(?:{pattern})$")


def is_private_ip(column: Column) -> Column:
    return _is(column, RFC1918)


def is_test_net_ip(column: Column) -> Column:
    return _is(column, TEST_NET)


def is_loopback_ip(column: Column) -> Column:
    return _is(column, LOOPBACK)


def is_sanitized_ip(column: Column) -> Column:
    """Addresses that the registry gives: documentation ranges and the shared range 100.64.0.0/10."""
    return is_test_net_ip(column) | _is(column, SHARED_NET)


def is_own_token(column: Column) -> Column:
    """Tokens of the registry, addresses of its ranges included."""
    value = F.trim(column)
    return value.rlike(OWN_TOKEN) | is_sanitized_ip(value)


def is_framework_id(column: Column) -> Column:
    return column.rlike(r"^(?i)(?:T[12]\d{3}(\.\d{3})?|TA0\d{3})$")


def public_domain(column: Column, domains: list[str]) -> Column:
    """Whether the name is one of the domains or below one: its suffixes are looked up among them."""
    name = F.regexp_replace(F.lower(F.trim(column)), r"\.+$", "")
    parts = F.split(name, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    return F.arrays_overlap(suffixes, F.array(*[F.lit(d) for d in domains])) if domains else F.lit(False)


def value_category(value: Column) -> Column:
    """Category of a whole value, by precedence: address, e-mail, SID, machine account, full host name."""
    return (
        F.when(_is(value, IPV4), F.when(is_private_ip(value), "ipv4_priv").otherwise("ipv4_pub"))
        .when(_is(value, EMAIL), "email").when(_is(value, SID), "sid").when(value.rlike(r"^[A-Z][A-Z0-9-]{2,30}\$$"), "machine_account").when(_is(value, FQDN), "fqdn")
    )


def hex_to_ip(column: Column) -> Column:
    return F.concat_ws(".", *[F.conv(F.substring(column, i, 2), 16, 10) for i in (1, 3, 5, 7)])


def ip_to_hex(column: Column) -> Column:
    parts = F.split(column, r"\.")
    return F.format_string("%02X%02X%02X%02X", *[parts[i].cast("int") for i in range(4)])
