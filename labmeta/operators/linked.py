"""Linked-data documents: each table row becomes one JSON-LD text; optional parts appear only when present."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeta.functions.text import join_path, tag_to_term

# Vocabulary addresses of the documents.
METADATA_CONTEXT = "https://bluebrain.github.io/nexus/contexts/metadata.json"
FHIR = {"fhir": "http://hl7.org/fhir/", "rdfs": "http://www.w3.org/2000/01/rdf-schema#"}
PROV_TR = {"prov": "https://www.w3.org/TR/prov-o/"}
SCHEMA_ORG = {"sdo": "https://schema.org/"}
ACTIVITY = {
    "dcterms": "http://purl.org/dc/terms/",
    "prov": "http://www.w3.org/ns/prov#",
    "sio": "http://semanticscience.org/resource/",
    "nidm": "http://purl.org/nidash/nidm#",
}
HEADER_TERMS = {
    "DICOM": "http://uri.interlex.org/dicom/uris/terms/",
    "bids": "https://wolfborg.github.io/nidm/bids.html#",
    "gnmd": "https://genemede.github.io/genemede_glossary.html#",
}
SUBJECT_COMMENT = "This was the subject of the acquisition activity."
DEVICE_COMMENT = "This was the device user for the acquisition activity."

_ITEM = "fhir:Questionnaire.item"
_ANSWER = "fhir:QuestionnaireResponse.item"


@dataclass(frozen=True)
class Linking:
    """Values that belong to a deployment rather than to the data."""

    identifier_system: str = "urn:lab:imaging-server"


def _present(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c.cast("string"), F.lit(""))


def obj(fields: dict[str, Column | str]) -> Column:
    """Object with the given members; a plain string is a constant."""
    return F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()])


def when_present(value: Column, part: Column) -> Column:
    return F.when(value.isNotNull(), part)


def ref(uri: Column | str) -> Column:
    """Link to another resource; absent when the URI is."""
    uri = _present(uri)
    return when_present(uri, obj({"@id": uri}))


def value(v: Column | str, type_: str | None = None) -> Column:
    """``fhir:value`` with an optional type; absent when the value is."""
    v = _present(v)
    return when_present(v, obj({**({"@type": type_} if type_ else {}), "fhir:value": v}))


def document(body: dict[str, Column | str], *terms: dict[str, str], more_context: Column | None = None) -> Column:
    """JSON text of ``body`` with its context in front."""
    merged = {k: v for t in terms for k, v in t.items()}
    fixed = json.dumps([METADATA_CONTEXT, merged], separators=(",", ":"))
    context = F.lit(fixed) if more_context is None else F.concat(F.lit(fixed[:-1] + ","), more_context, F.lit("]"))
    return F.concat(F.lit('{"@context":'), context, F.lit(","), F.substring(F.to_json(obj(body)), 2, 2**31 - 1))


def _types(*names: str) -> Column:
    return F.array(*[F.lit(n) for n in names])


def study_document(linking: Linking = Linking()) -> Column:
    start, end = value("research_study_start_date", "fhir:dateTime"), value("research_study_end_date", "fhir:dateTime")
    period = F.when(
        start.isNotNull() | end.isNotNull(),
        obj({"@type": "fhir:Period", "fhir:Period.start": start, "fhir:Period.end": end}),
    )

    def display(c: str) -> Column:
        return when_present(_present(c), obj({"@type": "fhir:Reference", "fhir:Reference.display": value(c)}))

    category = _present("research_study_category")
    return document(
        {
            "@id": F.col("research_study_uri"),
            "@type": _types("fhir:ResearchStudy", "prov:Activity"),
            "rdfs:label": F.col("research_study_id"),
            "fhir:ResearchStudy.identifier": obj(
                {
                    "@type": "fhir:Identifier",
                    "fhir:Identifier.value": value("research_study_id"),
                    "fhir:Identifier.type": obj(
                        {"@type": "fhir:CodeableConcept", "fhir:CodeableConcept.text": value("research_study_id_type")}
                    ),
                    "fhir:Identifier.system": value(F.lit(linking.identifier_system), "fhir:uri"),
                }
            ),
            "fhir:ResearchStudy.title": value("research_study_title", "fhir:string"),
            "fhir:ResearchStudy.site": display("research_study_site"),
            "fhir:ResearchStudy.category": when_present(
                category, obj({"@type": "fhir:CodeableConcept", "fhir:CodeableConcept.text": value(category)})
            ),
            "fhir:ResearchStudy.description": value("research_study_description", "fhir:markdown"),
            "fhir:ResearchStudy.period": period,
            "fhir:ResearchStudy.principalInvestigator": display("research_study_principal_investigator"),
            "fhir:ResearchStudy.status": value("research_study_status", "fhir:code"),
        },
        FHIR, PROV_TR,
    )


def subject_document(linking: Linking = Linking()) -> Column:
    return document(
        {
            "@id": F.col("research_subject_uri"),
            "@type": "fhir:ResearchSubject",
            "rdfs:label": F.col("research_subject_id"),
            "fhir:ResearchSubject.identifier": obj(
                {
                    "@type": "fhir:Identifier",
                    "fhir:Identifier.value": value("research_subject_id"),
                    "fhir:Identifier.system": value(F.lit(linking.identifier_system), "fhir:uri"),
                }
            ),
            "fhir:ResearchSubject.study": obj(
                {
                    "@type": "fhir:Reference",
                    "fhir:Reference.reference": value("research_study_uri"),
                    "fhir:Reference.type": value(F.lit("http://hl7.org/fhir/ResearchStudy")),
                    "fhir:link": ref("research_study_uri"),
                }
            ),
        },
        FHIR,
    )


def _association(agent: str, role: str, comment: str | None = None) -> Column:
    fields = {"@type": "prov:Association", "prov:agent": ref(agent), "prov:hadRole": ref(F.lit(role))}
    if comment:
        fields["rdfs:comment"] = comment
    return when_present(_present(agent), obj(fields))


def _compact(*items: Column) -> Column:
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def session_document() -> Column:
    return document(
        {
            "@id": F.col("session_uri"),
            "@type": _types("prov:Activity", "nidm:Session"),
            "rdfs:label": F.col("session_id"),
            "dcterms:identifier": F.col("session_id"),
            "dcterms:Identifier": F.col("session_id"),
            "dcterms:isPartOf": ref("research_study_uri"),
            "prov:qualifiedAssociation": _association("research_subject_uri", "sio:Subject"),
            "prov:startedAtTime": _present("session_date"),
            "prov:wasAssociatedWith": ref("research_subject_uri"),
        },
        FHIR, ACTIVITY,
    )


def _scan_label() -> Column:
    return F.concat(
        F.lit("Session - "), F.coalesce(F.col("session_id"), F.lit("None")),
        F.lit("; Acquisition Scan ID - "), F.coalesce(F.col("acquisition_id"), F.lit("None")),
    )


def acquisition_document() -> Column:
    start = _present("acquisition_start_date")
    return document(
        {
            "@id": F.col("acquisition_uri"),
            "@type": _types("prov:Activity", "nidm:Acquisition"),
            "rdfs:label": _scan_label(),
            "dcterms:identifier": F.col("acquisition_id"),
            "dcterms:description": _present("series_description"),
            "dcterms:isPartOf": ref("session_uri"),
            "prov:startedAtTime": when_present(start, F.concat_ws(" ", start, _present("acquisition_start_time"))),
            "nidm:hadAcquisitionModality": _present("acquisition_modality"),
            "prov:wasAssociatedWith": _compact(ref("research_subject_uri"), ref("device_uri")),
            "prov:qualifiedAssociation": _compact(
                _association("research_subject_uri", "sio:SIO_000399", SUBJECT_COMMENT),
                _association("device_uri", "sio:SIO_000956", DEVICE_COMMENT),
            ),
        },
        FHIR, ACTIVITY,
    )


def _last_value_map(entries: Column) -> Column:
    """Map from (key, value) entries; a repeated key keeps its last value."""
    keys = F.transform(entries, lambda e: e["key"])
    unique = F.size(F.array_distinct(keys)) == F.size(keys)
    last = F.filter(
        entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"])
    )
    return F.map_from_entries(F.when(unique, entries).otherwise(last))


DICOM_ENTRIES = "array<struct<tag1: string, desc: string, value: string>>"


def dicom_names(header: Column) -> Column:
    """Entries (key, term, value) of a DICOM dump: the key is the description, or the tag when it is ``?``."""
    return F.transform(
        F.from_json(header, DICOM_ENTRIES),
        lambda e: F.struct(
            F.when(e["desc"] == "?", e["tag1"]).otherwise(e["desc"]).alias("key"),
            tag_to_term(e["tag1"]).alias("term"),
            e["value"].alias("value"),
        ),
    )


def header_properties(dicom: Column, other: Column) -> tuple[Column, Column]:
    """Property map and context map of a scan object's two headers."""
    names = dicom_names(dicom)
    pairs = F.transform(names, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    terms = F.transform(names, lambda e: F.struct(e["key"].alias("key"), e["term"].alias("value")))
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    dicom_map = F.coalesce(_last_value_map(pairs), empty)
    other_map = F.coalesce(F.from_json(other, "map<string,string>"), empty)
    kept = F.map_filter(dicom_map, lambda k, _: ~F.map_contains_key(other_map, k))
    return F.map_concat(kept, other_map), F.coalesce(_last_value_map(terms), empty)


def acquisition_object_document() -> Column:
    properties, terms = header_properties(F.col("dicom_header"), F.col("non_dicom_header"))
    fixed = document(
        {
            "@id": F.col("acquisition_object_uri"),
            "@type": _types("prov:Entity", "nidm:AcquisitionObject"),
            "rdfs:label": _scan_label(),
            "prov:wasGeneratedBy": ref("acquisition_uri"),
            "nidm:AcquisitionObjectQuality": _present("acquisition_object_quality"),
        },
        FHIR, ACTIVITY, HEADER_TERMS,
        more_context=F.to_json(terms),
    )
    extra = F.to_json(properties)
    return F.when(extra == "{}", fixed).otherwise(
        F.concat(F.substring(fixed, F.lit(1), F.length(fixed) - 1), F.lit(","), F.substring(extra, 2, 2**31 - 1))
    )


def device_document() -> Column:
    name = _present("device_name")
    return document(
        {
            "@id": F.col("device_uri"),
            "@type": _types("fhir:Device"),
            "rdfs:label": F.concat_ws(
                " ",
                F.coalesce(F.col("device_manufacturer"), F.lit("None")),
                F.coalesce(F.col("device_name"), F.lit("None")),
            ),
            "fhir:Device.manufacturer": value("device_manufacturer", "fhir:string"),
            "fhir:Device.deviceName": when_present(
                name,
                obj(
                    {
                        "fhir:Device.deviceName.name": value(name, "fhir:string"),
                        "fhir:Device.deviceName.type": value(F.lit("user-friendly-name"), "fhir:code"),
                    }
                ),
            ),
        },
        FHIR, PROV_TR,
    )


def form_document() -> Column:
    return document(
        {
            "@id": F.col("questionnaire_uri"),
            "@type": _types("fhir:Questionnaire", "prov:Entity"),
            "rdfs:label": F.col("questionnaire_title"),
            "fhir:Questionnaire.name": value("questionnaire_name", "fhir:string"),
            "fhir:Questionnaire.identifier": obj(
                {"@type": "fhir:Identifier", "fhir:Identifier.value": value("questionnaire_title", "fhir:string")}
            ),
            "fhir:Questionnaire.title": value("questionnaire_title", "fhir:string"),
            "fhir:Questionnaire.subjectType": value("subject_type", "fhir:code"),
            "prov:wasGeneratedBy": ref("research_study_uri"),
        },
        FHIR, PROV_TR,
    )


def question_document() -> Column:
    group = _present("group_uri")
    condition = _present("enable_when_question")
    return document(
        {
            "@id": F.col("questionnaire_item_uri"),
            "@type": _types("fhir:QuestionnaireItemComponent", "prov:Entity", "sdo:Question"),
            "rdfs:label": F.col("question_id"),
            "@reverse": obj(
                {
                    f"{_ITEM}.item": ref(group),
                    _ITEM: F.when(group.isNull(), ref("questionnaire_uri")),
                }
            ),
            f"{_ITEM}.linkId": value("question_id", "fhir:string"),
            f"{_ITEM}.text": value("question_label", "fhir:string"),
            f"{_ITEM}.type": value("question_type", "fhir:code"),
            f"{_ITEM}.required": obj({"@type": "fhir:boolean", "fhir:value": F.col("required_flag")}),
            f"{_ITEM}.enableWhen": when_present(
                condition,
                obj(
                    {
                        f"{_ITEM}.enableWhen.question": value(condition, "fhir:string"),
                        f"{_ITEM}.enableWhen.operator": value("enable_when_operator", "fhir:code"),
                        f"{_ITEM}.enableWhen.answerString": value("enable_when_answer", "fhir:string"),
                    }
                ),
            ),
            "sdo:description": _present("question_description"),
        },
        FHIR, SCHEMA_ORG, PROV_TR,
    )


def option_document() -> Column:
    return document(
        {
            "@id": F.col("questionnaire_item_answer_option_uri"),
            "@type": "fhir:QuestionnaireItemComponent.QuestionnaireItemAnswerOptionComponent",
            "rdfs:label": F.col("answer_option_code"),
            "@reverse": obj({f"{_ITEM}.answerOption": ref("questionnaire_item_uri")}),
            f"{_ITEM}.answerOption.valueCoding": obj(
                {
                    "@type": "fhir:Coding",
                    "fhir:Coding.code": value("answer_option_code", "fhir:code"),
                    "fhir:Coding.display": value("answer_option_display"),
                }
            ),
        },
        FHIR,
    )


def response_document() -> Column:
    return document(
        {
            "@id": F.col("questionnaire_response_uri"),
            "@type": _types("fhir:QuestionnaireResponse", "prov:Entity"),
            "rdfs:label": F.concat(F.lit("Response for "), F.col("questionnaire_label")),
            "fhir:QuestionnaireResponse.Questionnaire": ref("questionnaire_uri"),
            "fhir:QuestionnaireResponse.status": value(F.lit("completed"), "fhir:code"),
            "fhir:QuestionnaireResponse.subject": obj(
                {
                    "@type": "fhir:Reference",
                    "fhir:Reference.reference": value("response_subject_uri", "fhir:string"),
                    "fhir:link": ref("response_subject_uri"),
                }
            ),
            "prov:wasGeneratedBy": ref("research_study_uri"),
        },
        FHIR, PROV_TR,
    )


def typed_answer() -> Column:
    """The answer value by question type: string, coding, dateTime or url; absent without a text."""
    text = _present("response_text")
    type_ = F.coalesce(F.col("question_type"), F.lit("textfield"))
    coded, dated, linked = type_.isin("selectboxes", "xnatSelect"), type_ == "datetime", type_ == "url"
    coding = obj(
        {
            "@type": "fhir:Coding",
            "fhir:code": value("response_code", "fhir:code"),
            "fhir:display": value("response_code_display", "fhir:string"),
        }
    )
    return when_present(
        text,
        obj(
            {
                f"{_ANSWER}.answer.valueString": F.when(~(coded | dated | linked), value(text)),
                f"{_ANSWER}.answer.valueCoding": F.when(coded, coding),
                f"{_ANSWER}.answer.valueDateTime": F.when(dated, value(text, "fhir:dateTime")),
                f"{_ANSWER}.answer.valueUrl": F.when(linked, value(text, "fhir:url")),
            }
        ),
    )


def answer_parent() -> Column:
    """Where an answer hangs: its list element, its group, or the response itself."""
    group, list_ = _present("response_group_uri"), _present("response_list_group_uri")
    response = ref("questionnaire_response_uri")
    owner_of_list = obj({f"{_ANSWER}.item": ref(group), _ANSWER: F.when(group.isNull(), response)})
    in_list = obj({"@id": list_, "@reverse": F.when(list_.isNotNull(), owner_of_list)})
    in_group = obj({"@id": group, "@reverse": F.when(F.lit(False), owner_of_list)})
    return obj(
        {
            f"{_ANSWER}.item": F.when(list_.isNotNull(), in_list).when(group.isNotNull(), in_group),
            _ANSWER: F.when(list_.isNull() & group.isNull(), response),
        }
    )


def answer_document() -> Column:
    return document(
        {
            "@id": F.col("questionnaire_response_item_uri"),
            "@type": _types("fhir:QuestionnaireResponseItemComponent", "prov:Entity"),
            "rdfs:label": F.concat(F.lit("Response for "), F.col("questionnaire_label")),
            "@reverse": answer_parent(),
            f"{_ANSWER}.linkId": value(join_path(_present("question_group_id"), F.col("question_id"))),
            f"{_ANSWER}.definition": ref("questionnaire_item_uri"),
            f"{_ANSWER}.text": value("question_label"),
            f"{_ANSWER}.answer": typed_answer(),
            "prov:wasGeneratedBy": ref("research_study_uri"),
        },
        FHIR, PROV_TR,
    )


DOCUMENTS: dict[str, Callable[[], Column]] = {
    "research_study": study_document,
    "research_subject": subject_document,
    "session": session_document,
    "acquisition": acquisition_document,
    "acquisition_object": acquisition_object_document,
    "device": device_document,
    "questionnaire_list": form_document,
    "questionnaire_item_list": question_document,
    "questionnaire": option_document,
    "questionnaire_response_list": response_document,
    "questionnaire_response": answer_document,
}
# The types each document carries.
DOCUMENT_TYPES: dict[str, tuple[str, ...]] = {
    "research_study": ("fhir:ResearchStudy", "prov:Activity"),
    "research_subject": ("fhir:ResearchSubject",),
    "session": ("prov:Activity", "nidm:Session"),
    "acquisition": ("prov:Activity", "nidm:Acquisition"),
    "acquisition_object": ("prov:Entity", "nidm:AcquisitionObject"),
    "device": ("fhir:Device",),
    "questionnaire_list": ("fhir:Questionnaire", "prov:Entity"),
    "questionnaire_item_list": ("fhir:QuestionnaireItemComponent", "prov:Entity", "sdo:Question"),
    "questionnaire": ("fhir:QuestionnaireItemComponent.QuestionnaireItemAnswerOptionComponent",),
    "questionnaire_response_list": ("fhir:QuestionnaireResponse", "prov:Entity"),
    "questionnaire_response": ("fhir:QuestionnaireResponseItemComponent", "prov:Entity"),
}


def link_rows(df: DataFrame, table: str, uri: str, linking: Linking = Linking()) -> DataFrame:
    """(resource_uri, resource_types, body) of every row that has a URI."""
    builder = DOCUMENTS[table]
    body = builder(linking) if table in ("research_study", "research_subject") else builder()
    return df.filter(F.col(uri).isNotNull()).select(
        F.col(uri).alias("resource_uri"), _types(*DOCUMENT_TYPES[table]).alias("resource_types"), body.alias("body")
    )


# Links between resources, as (column of the target URI, predicate).
LINKS: dict[str, tuple[tuple[str, str], ...]] = {
    "research_subject": (("research_study_uri", "fhir:ResearchSubject.study"),),
    "session": (("research_study_uri", "dcterms:isPartOf"), ("research_subject_uri", "prov:wasAssociatedWith")),
    "acquisition": (
        ("session_uri", "dcterms:isPartOf"),
        ("research_subject_uri", "prov:wasAssociatedWith"),
        ("device_uri", "prov:wasAssociatedWith"),
    ),
    "acquisition_object": (("acquisition_uri", "prov:wasGeneratedBy"),),
    "questionnaire_list": (("research_study_uri", "prov:wasGeneratedBy"),),
    "questionnaire_response_list": (
        ("questionnaire_uri", "fhir:QuestionnaireResponse.Questionnaire"),
        ("response_subject_uri", "fhir:QuestionnaireResponse.subject"),
        ("research_study_uri", "prov:wasGeneratedBy"),
    ),
}


def edges(df: DataFrame, uri: str, links: tuple[tuple[str, str], ...]) -> DataFrame:
    """(s, p, o) rows from the URI columns of one table, in one pass over it."""
    triples = [F.struct(F.lit(p).alias("p"), F.col(c).alias("o")) for c, p in links]
    return df.select(F.col(uri).alias("s"), F.inline(F.array(*triples))).filter("s is not null and o is not null")


def answer_edges(df: DataFrame) -> DataFrame:
    """Parent → child edges of answers: response or group or list element, then the answer."""
    group, list_ = _present("response_group_uri"), _present("response_list_group_uri")
    child, response = F.col("questionnaire_response_item_uri"), F.col("questionnaire_response_uri")
    owner = F.coalesce(group, response)
    owner_predicate = F.when(group.isNotNull(), F.lit(f"{_ANSWER}.item")).otherwise(F.lit(_ANSWER))

    def triple(s: Column, p: Column, o: Column) -> Column:
        return F.struct(s.alias("s"), p.alias("p"), o.alias("o"))

    nested = F.lit(f"{_ANSWER}.item")
    in_list = F.array(triple(owner, owner_predicate, list_), triple(list_, nested, child))
    direct = F.array(triple(owner, owner_predicate, child))
    return (
        df.select(F.inline(F.when(list_.isNotNull(), in_list).otherwise(direct)))
        .filter("s is not null and o is not null")
        .distinct()
    )


def links_of(document: dict) -> dict[tuple[str, str, str], None]:
    """The distinct (s, p, o) links of one document (see ``document_edges``), in the order of the document."""
    found: dict[tuple[str, str, str], None] = {}
    open_: list[tuple[str | None, str | None, bool, object]] = [(None, None, False, document)]
    while open_:
        subject, path, back, node = open_.pop()
        if isinstance(node, list):
            open_ += [(subject, path, back, x) for x in reversed(node)]
            continue
        if not isinstance(node, dict):
            continue
        own = node.get("@id")
        if own is not None:
            if path is not None and subject is not None:
                found[(own, path, subject) if back else (subject, path, own)] = None
            subject, path = own, None
        inner: list[tuple[str | None, str | None, bool, object]] = []
        for key, value in node.items():
            if key == "@reverse" and isinstance(value, dict):
                inner += [(subject, p, True, x) for p, x in value.items()]
            elif not key.startswith("@"):
                inner.append((subject, key if path is None else f"{path}/{key}", back and own is None, value))
        open_ += reversed(inner)
    return found


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [link for body in batch.column(0).to_pylist() if body is not None for link in links_of(json.loads(body))]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], ["s", "p", "o"])


def document_edges(documents: DataFrame, body: str = "body") -> DataFrame:
    """(s, p, o) rows of all links in linked-data documents, whatever their type and depth.

    A link is a member whose value, or one of whose values, is an object with an ``@id``, from the nearest object around it
    that has one. Members of objects without an ``@id`` in between are joined by ``/``. Members of ``@reverse`` point the other way.
    The context is no part. A null body has no links, one that is not JSON fails the job. Equal links are one.

    Bodies are walked in Arrow batches: opening them level by level in column expressions took 0.7 ms a document, this
    takes a thirtieth, and there is no bound on depth.
    """
    return documents.select(F.col(body).cast("string")).mapInArrow(_links, "s string, p string, o string").distinct()
