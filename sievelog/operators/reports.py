"""Report rows of incidents: a summary and a text of the sentences that apply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .incidents import incident_summary

#: Which engine the incidents come from, as the sentences name it.
ENGINE = "the correlation engine"


def iso_time(epoch: Column) -> Column:
    """The second in UTC; a null or zero time is unknown."""
    seconds = F.coalesce(epoch.cast("double"), F.lit(0.0)).cast("long")
    day = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int")), "yyyy-MM-dd")
    rest = F.pmod(seconds, F.lit(86400))
    clock = F.format_string("%02d:%02d:%02d", F.floor(rest / 3600), F.floor(rest / 60) % 60, rest % 60)
    return F.when(F.coalesce(epoch.cast("double"), F.lit(0.0)) == 0, "unknown time").otherwise(F.concat(day, F.lit("T"), clock, F.lit("Z")))


def duration(seconds: Column) -> Column:
    s = seconds.cast("long")
    form = lambda n, unit: F.concat(n.cast("long").cast("string"), F.lit(unit))
    return F.when(s < 60, form(s, "s")).when(s < 3600, form(F.floor(s / 60), "m")).when(s < 86400, form(F.floor(s / 3600), "h")).otherwise(form(F.floor(s / 86400), "d"))


def plural(n: Column, word: str) -> Column:
    return F.concat(n.cast("string"), F.lit(f" {word}"), F.when(n == 1, "").otherwise("s"))


def score(x: Column) -> Column:
    """Two decimals, rounded half up on the decimal value."""
    return F.round(x.cast("decimal(18,6)"), 2)


def short_list(items: Column, most: int, form: str = " (and {} more)") -> Column:
    before, after = form.split("{}")
    rest = F.size(items) - most
    return F.concat(F.array_join(F.slice(items, 1, most), ", "), F.when(rest > 0, F.concat(F.lit(before), rest.cast("string"), F.lit(after))).otherwise(""))


def cut(text: Column, most: int = 240) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)


def report_text(engine: str = ENGINE) -> Column:
    """Up to eleven sentences over the columns of ``incident_summary``."""
    c = F.col
    first, last = (F.coalesce(c(x).cast("double"), F.lit(0.0)) for x in ("first_observed_at", "last_observed_at"))
    took = last.cast("long") - first.cast("long")
    label = F.concat(F.lit("`"), c("incident_id"), F.lit("`"), F.when(c("name") != "", F.concat(F.lit(" (`"), c("name"), F.lit("`)"))).otherwise(""))
    counts = F.array_compact(F.array(*[F.when(c(n) > 0, plural(c(n), word)) for n, word in (("lead_count", "triggering signal"), ("node_count", "node"), ("edge_count", "edge"))]))
    listed = lambda column, lead, text: F.when(F.size(column) > 0, F.concat(F.lit(lead), text, F.lit(".")))
    more = ", and {} more"
    sentences = [
        F.concat(F.lit("Incident "), label, F.lit(f" was classified by {engine} as **"), c("mo_name"), F.lit("** with a suspicion score of "), score(c("suspicion_score")).cast("string"), F.lit(" and a final disposition of **"), c("status_name"), F.lit("** (`disposition_category="), c("disposition_category"), F.lit("`).")),
        F.concat(F.lit("The attack chain began at `"), iso_time(first), F.lit("` and was last observed at `"), iso_time(last), F.lit("`"), F.when((first != 0) & (last != 0) & (took > 0), F.concat(F.lit(" (duration: "), duration(took), F.lit(")"))).otherwise(""), F.lit(".")),
        F.when(F.size(counts) > 0, F.concat(F.lit("The incident graph contains "), F.array_join(counts, ", "), F.lit("."))),
        listed("set_role_names", "Classification roles assigned: ", short_list(c("set_role_names"), 6)),
        listed("matched_rules", "Detection rules triggered: ", short_list(F.transform("matched_rules", lambda r: F.concat(F.lit('"'), r, F.lit('"'))), 8, more)),
        listed("products_observed", "Security products that observed activity: ", short_list(c("products_observed"), 6)),
        listed("attack_tactics", "Mapped MITRE ATT&CK tactics: ", F.array_join("attack_tactics", ", ")),
        listed("attack_techniques", "Mapped MITRE ATT&CK techniques: ", short_list(c("attack_techniques"), 10, more)),
        F.when(c("lifecycle_stage") != "unknown", F.concat(F.lit("Inferred kill-chain stage: `"), c("lifecycle_stage"), F.lit("`."))),
        F.when(c("first_details") != "", F.concat(F.lit("Sample triggering signal: `"), cut(c("first_details")), F.lit("`."))),
        F.lit(f"This report was generated deterministically from structured incident metadata; it reflects the output of {engine}, not an independent threat-hunting investigation."),
    ]
    return F.concat_ws(" ", *sentences)


COLUMNS = ("incident_id", "report_text", "report_source", "mo_name", "suspicion_score", "status_name", "disposition", "disposition_category", "attack_techniques", "attack_tactics", "lead_count", "node_count", "edge_count", "first_observed_at", "last_observed_at", "set_role_names", "matched_rules", "products_observed", "lifecycle_stage")


def attack_reports(incidents: DataFrame, sets: DataFrame, engine: str = ENGINE) -> DataFrame:
    """One row of 19 fields for each incident, all from its own row."""
    return incident_summary(incidents, sets).withColumns({"report_text": report_text(engine), "report_source": F.lit("template")}).select(*COLUMNS)
