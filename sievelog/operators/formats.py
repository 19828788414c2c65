"""The format of a log message, by its stream, type or pipeline, else by how it begins."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

AGENT_PREFIX = r"^\s*(?:\S+-)?WinLogBeat :::"
_AGENT = re.compile(AGENT_PREFIX, re.ASCII).search


def message_format(message: Column, stream: Column, message_type: Column, pipeline: Column) -> Column:
    """Format of a message: by its stream, type or pipeline, else by how it begins. Names are compared whole, without case."""
    s, t, p = (F.lower(F.coalesce(c, F.lit(""))) for c in (stream, message_type, pipeline))
    text = F.coalesce(message, F.lit(""))
    begins = F.substring(text, 1, 200)
    xml = lambda c: c.contains("<Event")
    windows = F.when(text.rlike(AGENT_PREFIX), "winlogbeat").when(xml(text), "windows_xml").otherwise("winlogbeat")
    return (
        F.when(s == "cisco_asa", "cisco_asa")
        .when(s.isin("windows_security_audit", "microsoft-windows-security-auditing"), windows)
        .when(s.isin("aws_cloud_trail", "aws_cloudtrail_events") | p.contains("cloudtrail"), "aws_cloudtrail")
        .when((s == "dnsmasq") | (t == "dns_event"), "dns_event")
        .when(s.isin("vcenter", "vmware"), "vmware")
        .when(s == "meraki", "meraki")
        .when(s.isin("pan_firewall", "palo_alto") | t.isin("traffic_drop", "traffic_allow"), "palo_alto")
        .when(text.rlike(AGENT_PREFIX), "winlogbeat")
        .when(xml(begins), "windows_xml").when(begins.contains("%ASA-"), "cisco_asa").when(F.lower(begins).contains("cloudtrail"), "aws_cloudtrail")
        .otherwise("generic")
    )


def text_format(text: str, stream: str, message_type: str, pipeline: str) -> str:
    """``message_format`` of one message, for tasks that have its record at hand."""
    s, t, p = stream.lower(), message_type.lower(), pipeline.lower()
    if s == "cisco_asa":
        return "cisco_asa"
    if s in ("windows_security_audit", "microsoft-windows-security-auditing"):
        return "winlogbeat" if _AGENT(text) or "<Event" not in text else "windows_xml"
    if s in ("aws_cloud_trail", "aws_cloudtrail_events") or "cloudtrail" in p:
        return "aws_cloudtrail"
    if s == "dnsmasq" or t == "dns_event":
        return "dns_event"
    if s in ("vcenter", "vmware"):
        return "vmware"
    if s == "meraki":
        return "meraki"
    if s in ("pan_firewall", "palo_alto") or t in ("traffic_drop", "traffic_allow"):
        return "palo_alto"
    if "WinLogBeat" in text and _AGENT(text):
        return "winlogbeat"
    begins = text[:200]
    if "<Event" in begins:
        return "windows_xml"
    return "cisco_asa" if "%ASA-" in begins else "aws_cloudtrail" if "cloudtrail" in begins.lower() else "generic"
