"""Nested incidents read their lines once, and what is made of an incident is made within its row."""

import __spark_entry__ as entry
from sievelog.operators import graph, incidents
from sievelog.plans import views

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_read_once(spark):
    cases = views.cases(spark, SF)
    assert plan(cases).count("Relation [l_orderkey") == 1
    assert plan(entry.queries()["g5_incident_edges"](spark, SF)).count("Relation [l_orderkey") == 1


def test_documents_are_written_in_their_row(spark):
    labelled = incidents.incident_labels(views.cases(spark, SF), views.catalog(spark)[1])
    made = graph.incident_graphml(labelled)
    assert plan(made).count("Join") == plan(labelled).count("Join")
    assert plan(made).count("Generate") == 0
    assert {r[0] for r in made.select("incident_id").collect()} == {r[0] for r in labelled.select("id").collect()}
