"""Unknown elements at every depth."""
import json

from pyspark.sql import functions as F

from gapwise.operators.paths import automaton, first_unknown, with_unknown_paths

CASES = [
    ({"resourceType": "Patient", "name": [{"family": "x", "given": ["a"], "_family": {"id": "1"}}]}, []),
    ({"resourceType": "Patient", "name": [{"family": "x"}, {"nickname": "y"}], "colour": 1},
     ["Patient.colour", "Patient.name[1].nickname"]),
    ({"resourceType": "Patient", "_birthDate": {"extension": [{"anything": {"goes": 1}}]}, "contained": [{"any": 1}]}, []),
    ({"resourceType": "Patient", "identifier": [{"type": {"coding": [{"code": "a"}, {"shade": "b"}]}}]},
     ["Patient.identifier[0].type.coding[1].shade"]),
    ({"resourceType": "Condition", "code": {"coding": [{"code": "1", "colour": "red"}]}, "subject": {"reference": "Patient/1"}},
     ["Condition.code.coding[0].colour"]),
    ({"resourceType": "Observation", "component": [{"valueQuantity": {"value": 1, "unit": "m", "units": "m"}}]},
     ["Observation.component[0].valueQuantity.units"]),
    ({"resourceType": "Observation", "subject": {"identifier": {"assigner": {"identifier": {"assigner": {"who": 1}}}}}},
     ["Observation.subject.identifier.assigner.identifier.assigner.who"]),
    ({"resourceType": "Procedure", "performer": [{"actor": {"ref": "x"}}], "note": [{"text": "t"}]},
     ["Procedure.performer[0].actor.ref"]),
    ({"resourceType": "Organization", "whatever": {"x": 1}}, []), ({"resourceType": "Patient"}, []), (None, []), ([], []),
]


def test_paths_of_every_depth(spark):
    rows = [(f"o{k}", 0, None if r is None else json.dumps(r)) for k, (r, _) in enumerate(CASES)]
    entries = spark.createDataFrame(rows, "object_name string, pos int, doc string").select(
        "object_name", "pos", F.try_parse_json("doc").alias("resource")).withColumn(
        "resource_type", F.try_variant_get("resource", "$.resourceType", "string"))
    got = {r.object_name: list(r.unknown) for r in with_unknown_paths(entries).collect()}
    assert got == {f"o{k}": want for k, (_, want) in enumerate(CASES)}
    first = {r.object_name: r.path for r in first_unknown(entries).collect()}
    assert first == {f"o{k}": want[0] for k, (_, want) in enumerate(CASES) if want}


def test_every_edge_leads_to_a_state():
    states = automaton()
    assert {to for edges in states.values() for to in edges.values()} <= {"", "*", *states}
