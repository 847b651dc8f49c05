"""Unknown elements at every depth of a resource.

The allowed elements form an automaton: a state is an element type, an edge an
element name, and a path of names is legal if the automaton can follow it. Array
steps keep the state, choice elements (``valueQuantity``) are names of their own,
``_name`` beside a primitive element leads to its id and extensions. An edge into
``ANY`` ends the walk: what lies below is not checked.

The walk is part of the row: a frontier of (path, state, value) is taken one step
down at a time, through objects as maps and arrays as arrays of VARIANT, for as
many steps as ``DEPTH``. A step that meets no edge leaves its path in the frontier.
There is no explode, no shuffle, and no rows but those of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.operators.ingest import KNOWN_ELEMENTS

DEPTH = 24  # steps of the walk, arrays counted; a legal resource of these types is far shallower
ANY, BAD = "*", "!"

# --- fixed values: elements of the FHIR R4 data types that measures inputs use (public specification).
# ``name`` is primitive, ``name:Type`` has elements of its own. Every type also has id and extension.
DATA_TYPES = {
    "Meta": "versionId lastUpdated source profile security:Coding tag:Coding",
    "Narrative": "status div",
    "Coding": "system version code display userSelected",
    "CodeableConcept": "coding:Coding text",
    "Reference": "reference type identifier:Identifier display",
    "Identifier": "use type:CodeableConcept system value period:Period assigner:Reference",
    "Period": "start end",
    "HumanName": "use text family given prefix suffix period:Period",
    "ContactPoint": "system value use rank period:Period",
    "Address": "use type text line city district state postalCode country period:Period",
    "Quantity": "value comparator unit system code",
    "Range": "low:Quantity high:Quantity",
    "Ratio": "numerator:Quantity denominator:Quantity",
    "Annotation": "authorReference:Reference authorString time text",
    "PatientContact": "relationship:CodeableConcept name:HumanName telecom:ContactPoint address:Address gender "
                      "organization:Reference period:Period",
    "PatientLink": "other:Reference type",
    "PatientCommunication": "language:CodeableConcept preferred",
    "ConditionEvidence": "code:CodeableConcept detail:Reference",
    "ObservationComponent": "code:CodeableConcept valueQuantity:Quantity valueCodeableConcept:CodeableConcept valueString "
                            "valueBoolean valueInteger valueRange:Range valueRatio:Ratio valueTime valueDateTime "
                            "valuePeriod:Period dataAbsentReason:CodeableConcept interpretation:CodeableConcept "
                            "referenceRange:ReferenceRange",
    "ReferenceRange": "low:Quantity high:Quantity type:CodeableConcept appliesTo:CodeableConcept age:Range text",
    "ProcedurePerformer": "function:CodeableConcept actor:Reference onBehalfOf:Reference",
    "EncounterParticipant": "type:CodeableConcept period:Period individual:Reference",
}
#: Types of the elements of resources that have elements of their own; in some resources only.
COMMON = ("meta:Meta text:Narrative identifier:Identifier code:CodeableConcept subject:Reference encounter:Reference "
          "category:CodeableConcept bodySite:CodeableConcept note:Annotation basedOn:Reference partOf:Reference")
OWN = {
    "Patient": "name:HumanName telecom:ContactPoint address:Address maritalStatus:CodeableConcept contact:PatientContact "
               "communication:PatientCommunication generalPractitioner:Reference managingOrganization:Reference link:PatientLink",
    "Condition": "clinicalStatus:CodeableConcept verificationStatus:CodeableConcept severity:CodeableConcept onsetPeriod:Period "
                 "onsetRange:Range onsetAge:Quantity abatementPeriod:Period abatementRange:Range abatementAge:Quantity "
                 "recorder:Reference asserter:Reference evidence:ConditionEvidence",
    "Observation": "focus:Reference effectivePeriod:Period performer:Reference valueQuantity:Quantity "
                   "valueCodeableConcept:CodeableConcept valueRange:Range valueRatio:Ratio valuePeriod:Period "
                   "dataAbsentReason:CodeableConcept interpretation:CodeableConcept method:CodeableConcept specimen:Reference "
                   "device:Reference referenceRange:ReferenceRange hasMember:Reference derivedFrom:Reference "
                   "component:ObservationComponent",
    "Procedure": "statusReason:CodeableConcept performedPeriod:Period performedRange:Range performedAge:Quantity "
                 "recorder:Reference asserter:Reference performer:ProcedurePerformer location:Reference "
                 "reasonCode:CodeableConcept reasonReference:Reference outcome:CodeableConcept report:Reference "
                 "complication:CodeableConcept complicationDetail:Reference followUp:CodeableConcept "
                 "usedReference:Reference usedCode:CodeableConcept",
    "Encounter": "class:Coding type:CodeableConcept serviceType:CodeableConcept priority:CodeableConcept "
                 "episodeOfCare:Reference participant:EncounterParticipant appointment:Reference period:Period length:Quantity "
                 "reasonCode:CodeableConcept reasonReference:Reference account:Reference serviceProvider:Reference",
}
#: Elements of resources whose content is not checked: any resource or extension may stand there, or
#: their types are not listed above.
UNCHECKED = ("contained extension modifierExtension photo stage statusHistory classHistory diagnosis hospitalization "
             "focalDevice valueSampledData effectiveTiming")


def _edges(elements: str) -> dict[str, str]:
    """Edges of a type: primitive elements lead nowhere below (""), ``_name`` to anything."""
    out = {"id": "", "extension": ANY}
    for e in elements.split():
        name, _, kind = e.partition(":")
        out[name] = kind
        if not kind:
            out[f"_{name}"] = ANY
    return out


def automaton() -> dict[str, dict[str, str]]:
    """state → element name → state; "" below a primitive element, ``ANY`` where nothing is checked."""
    states = {t: _edges(elements) for t, elements in DATA_TYPES.items()}
    for resource, names in KNOWN_ELEMENTS.items():
        kinds = {**_edges(COMMON), **_edges(OWN[resource]), **dict.fromkeys(UNCHECKED.split(), ANY)}
        states[resource] = _edges(" ".join(f"{n}:{kinds.get(n, '')}".rstrip(":") for n in names if n != "id"))
    return states


def _edge_map() -> Column:
    pairs = []
    for state, edges in automaton().items():
        inner = [x for name, to in edges.items() for x in (F.lit(name), F.lit(to))]
        pairs += [F.lit(state), F.create_map(*inner)]
    return F.create_map(*pairs)


_ITEM = "array<struct<path: string, state: string, value: variant>>"


def _down(x: Column) -> Column:
    """The frontier below one of its members; a path that is bad stays."""
    elements = F.try_variant_get(x["value"], "$", "array<variant>")
    fields = F.map_entries(F.try_variant_get(x["value"], "$", "map<string,variant>"))
    edges = F.try_element_at(_edge_map(), x["state"])
    inside = F.transform(elements, lambda e, i: F.struct(
        F.concat(x["path"], F.lit("["), i.cast("string"), F.lit("]")).alias("path"), x["state"].alias("state"), e.alias("value")))
    below = F.filter(F.transform(fields, lambda f: F.struct(
        F.concat(x["path"], F.lit("."), f["key"]).alias("path"),
        F.coalesce(F.try_element_at(edges, f["key"]), F.lit(BAD)).alias("state"), f["value"].alias("value"))),
        lambda y: ~y["state"].isin("", ANY))
    return F.when(x["state"] == BAD, F.array(x)).otherwise(F.coalesce(inside, below, F.array().cast(_ITEM)))


def unknown_paths(resource: Column, resource_type: Column) -> Column:
    """The paths in ``resource`` that its type does not allow, sorted; empty for a type that is not checked.

    Paths begin with the type, as in ``Patient.name[0].nickname``.
    """
    start = F.when(resource_type.isin(list(KNOWN_ELEMENTS)) & resource.isNotNull(), F.filter(
        F.transform(F.map_entries(F.try_variant_get(resource, "$", "map<string,variant>")), lambda f: F.struct(
            F.concat(resource_type, F.lit("."), f["key"]).alias("path"),
            F.coalesce(F.try_element_at(F.try_element_at(_edge_map(), resource_type), f["key"]), F.lit(BAD)).alias("state"),
            f["value"].alias("value"))), lambda y: ~y["state"].isin("", ANY)))
    frontier = F.coalesce(start, F.array().cast(_ITEM))
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(DEPTH)), frontier,
                         lambda now, _: F.flatten(F.transform(now, _down)))
    return F.array_sort(F.transform(F.filter(walked, lambda x: x["state"] == BAD), lambda x: x["path"]))


def with_unknown_paths(entries: DataFrame) -> DataFrame:
    """``entries(resource, resource_type, ...)`` with ``unknown``, every path that is not allowed."""
    return entries.withColumn("unknown", unknown_paths(F.col("resource"), F.col("resource_type")))


def first_unknown(entries: DataFrame) -> DataFrame:
    """(object_name, path): the first bad path of each bundle, by position of the entry, then path."""
    bad = with_unknown_paths(entries).where(F.size("unknown") > 0)
    return bad.groupBy("object_name").agg(F.min_by(F.col("unknown")[0], "pos").alias("path"))
