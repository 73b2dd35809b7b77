"""Form answers: nested documents to one row per answer, joined to the form definitions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labmeta.functions.documents import Double, json_object, scalar_text, walk_documents
from labmeta.functions.keys import escaped_parts, seed_parts
from labmeta.functions.text import join_path, parent_index
from labmeta.schemas import ANSWER_GROUP_TYPES, OPTION_TYPES

# Types whose rows repeat once per option in the schema and are reduced to the option chosen.
SINGLE_CHOICE = tuple(t for t in OPTION_TYPES if t != "selectboxes")


@dataclass(frozen=True)
class Naming:
    """Where new URIs start and the secret that goes into their seed."""

    base: str = "urn:lab:"
    salt: str = ""
    delimiter: str = "|"


def explode_document(docs: DataFrame, document: str = "xnat_custom_fields") -> DataFrame:
    """One row per top-level key with its value as text and its ordinal, from 0 in document order, as index.

    A null, blank or ``null`` document has no keys. Any other that is not a JSON object fails the job.
    """
    keep, text, none = [c for c in docs.columns if c != document], F.col(document), F.lit(None).cast("string")
    # It is part of the map that is exploded, so no query can prune it.
    unreadable = F.when(~F.trim(text).isin("", "null"), F.raise_error(F.lit(_UNREADABLE)).cast("map<string,string>"))
    entries = F.posexplode(F.coalesce(F.from_json(text, "map<string,string>"), unreadable))
    return docs.select(*keep, entries.alias("_pos", "question_id", "response_text")).select(
        *keep,
        "question_id",
        "response_text",
        F.col("_pos").cast("string").alias("response_index_in_list"),
        none.alias("question_group_id"),
        none.alias("response_list_group_uri"),
        F.lit(False).alias("multiselect"),
    )


_UNREADABLE = "an answer document is not a JSON object"
# Question names whose seeds a task keeps.
_NAMES = 20_000
# What a row holds: text, a ticked box, or a number to be written as a double (which at the top level is quoted if it is not finite).
_TEXT, _TICKED, _DOUBLE, _TOP_DOUBLE = range(4)
_ROW = (
    "question_id string, question_group_id string, response_text string, response_index_in_list string, "
    "response_list_group_uri string, _holds tinyint"
)


def _add_answers(add: Callable[[tuple], None], document: str, subject: str, naming: Naming, names: dict) -> None:
    """Add a row (as ``_ROW``) for each answer of a document: its top members, and what its objects and lists hold.

    ``names`` keeps the seeds of questions, which documents share.
    """
    members = json_object(document, _UNREADABLE)
    mark, end, base, open_ = naming.delimiter, naming.delimiter + naming.salt, naming.base, []

    def uri(seed: str) -> str:
        h = sha256((seed + end).encode("utf-8", "replace")).hexdigest()
        return f"{base}{h[:8]}-{h[8:12]}-4{h[13:16]}-8{h[17:20]}-{h[20:32]}"

    for i, (key, value) in enumerate(members):
        kind = type(value)
        if kind is tuple or kind is list:
            open_.append((key, None, str(i), None, value))
        else:
            add((key, None, scalar_text(value), str(i), None, _TOP_DOUBLE if kind is Double else _TEXT))
    while open_:
        question, path, index, list_uri, node = open_.pop()
        name = names.get((path, question))
        if name is None:
            if len(names) >= _NAMES:
                names.clear()
            name = names[path, question] = escaped_parts(("" if path is None else path, question), mark)
        seed = f"{subject}{mark}{name}{mark}{escaped_parts((index,), mark)}"
        if type(node) is tuple:
            # The object stays as a row without text.
            add((question, path, None, index, list_uri, _TEXT))
            own, below = uri(seed), question if path is None else f"{path}.{question}"
            for i, (key, value) in enumerate(node):
                kind = type(value)
                if kind is str or value is None:
                    add((key, below, value, f"{index}.{i}", own, _TEXT))
                elif kind is tuple or kind is list:
                    open_.append((key, below, f"{index}.{i}", own, value))
                elif value is True:
                    add((question, path, key, f"{index}.{i}", own, _TICKED))
                elif value is not False:
                    add((key, below, value, f"{index}.{i}", own, _DOUBLE))
        else:
            for i, value in enumerate(node):
                kind, own = type(value), uri(f"{seed}{mark}{i}")
                if kind is tuple or kind is list:
                    open_.append((question, path, f"{index}.{i}", own, value))
                else:
                    add((question, path, scalar_text(value), f"{index}.{i}", own, _DOUBLE if kind is Double else _TEXT))


def flatten_answers(
    docs: DataFrame,
    subject: str = "response_subject_uri",
    document: str = "xnat_custom_fields",
    naming: Naming = Naming(),
    folder: str | None = None,
) -> DataFrame:
    """Documents to answer rows, down to any depth, in one pass over the documents and without a shuffle.

    An object stays as a row with null text; its members take the object's path and number. A false
    check-box is dropped after numbering and a true one becomes (object, key). A list is replaced by its
    items, numbered below the list's own index. A document that is not a JSON object fails the job rather than losing
    answers. With ``folder``, a new one in a shared place, the rows are written there and read back, for a plan that uses them
    more than once.

    Documents are walked in Arrow batches, each once: opening them level by level in column expressions took every row
    through every level, 0.4 ms for a document of four levels.
    """
    keep = [c for c in docs.columns if c != document]
    seed = seed_parts([F.col(subject)], naming.delimiter)
    walked = walk_documents(docs, keep, F.col(document), seed, _ROW, partial(_add_answers, naming=naming, names={}))
    holds = F.col("_holds")
    number = F.when(holds.isin(_DOUBLE, _TOP_DOUBLE), F.col("response_text")).cast("double").cast("string")
    quoted = (holds == _TOP_DOUBLE) & number.isin("NaN", "Infinity", "-Infinity")
    text = F.when(number.isNull(), F.col("response_text")).when(quoted, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number)
    answers = walked.select(
        *keep, "question_id", "question_group_id", text.alias("response_text"), "response_index_in_list",
        "response_list_group_uri", (holds == _TICKED).alias("multiselect"),
    )
    if folder is None:
        return answers
    answers.write.parquet(folder)
    return docs.sparkSession.read.schema(answers.schema).parquet(folder)


def subject_x_form(subjects: DataFrame, forms: DataFrame) -> DataFrame:
    """One response header per subject and form of the subject's study and data type."""
    side = forms.select(
        F.col("research_study_id").alias("_study"),
        F.col("xnat_data_type").alias("_type"),
        *[c for c in forms.columns if c not in ("research_study_id", "xnat_data_type", "questionnaire_name")],
        F.col("questionnaire_name").alias("questionnaire_label"),
    )
    same = (F.col("research_study_id") == F.col("_study")) & (F.col("xnat_data_type") == F.col("_type"))
    return subjects.join(side, same, "inner").drop("_study", "_type")


def form_questions(options: DataFrame, forms: DataFrame) -> DataFrame:
    """Questions and options of the listed forms, named as answer columns."""
    active = forms.select("questionnaire_uri").distinct()
    return options.join(active, "questionnaire_uri", "left_semi").select(
        F.col("answer_option_code").alias("response_code"),
        F.col("answer_option_display").alias("response_code_display"),
        F.col("group_id").alias("question_group_id"),
        F.col("group_uri").alias("question_group_uri"),
        "question_id",
        "question_label",
        "question_type",
        F.col("questionnaire_item_answer_option_uri").alias("response_code_uri"),
        "questionnaire_item_uri",
        "questionnaire_uuid",
        F.col("questionnaire_title").alias("questionnaire_label"),
        "questionnaire_uri",
        "required_flag",
        "research_study_id",
        "research_study_id_type",
        "research_study_title",
        "research_study_uri",
        "src_system",
        "subject_type",
        "xnat_data_type",
    )


def datamap_questions(options: DataFrame, forms: DataFrame) -> DataFrame:
    """Form attributes for user-typed keys, found by the data map's path (null when it is in no group)."""
    maps = options.filter(F.col("question_type") == "datamap")
    return form_questions(maps, forms).select(
        F.concat(F.col("question_group_id"), F.lit("."), F.col("question_id")).alias("question_group_id"),
        F.col("questionnaire_item_uri").alias("question_group_uri"),
        "response_code", "response_code_display", "questionnaire_uuid", "questionnaire_label", "questionnaire_uri",
        "research_study_id", "research_study_id_type", "research_study_title", "research_study_uri", "src_system",
        "subject_type", "xnat_data_type",
    )


_SCOPE = ("research_study_id", "xnat_data_type")


def _side(schema: DataFrame, on: Sequence[str]) -> DataFrame:
    return schema.select([F.col(c).alias(f"_schema_{c}") if c in on else F.col(c) for c in schema.columns])


def _same(on: Sequence[str]) -> Column:
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_schema_{c}"))
    return same


def join_answers(answers: DataFrame, schema: DataFrame, scope: Sequence[str] = _SCOPE) -> DataFrame:
    """Answers with the attributes of their question.

    Check-box answers match (question, path, option display); an answer that is no option is left out.
    All others keep every answer row and match (question, path), once per option of the question.
    """
    on = [*scope, "question_id", "question_group_id"]
    boxes = F.coalesce(F.col("question_type") == "selectboxes", F.lit(False))
    chosen = F.col("response_text") == F.col("response_code_display")
    fits = F.when(F.col("multiselect"), boxes & chosen).otherwise(~boxes)
    joined = answers.join(_side(schema, on), _same(on) & fits, "left").drop(*[f"_schema_{c}" for c in on])
    return joined.filter(~F.col("multiselect") | F.col("src_system").isNotNull())


def keep_selected(joined: DataFrame, types: Sequence[str] = SINGLE_CHOICE) -> DataFrame:
    """For single-choice questions only the option whose display equals the answer."""
    wrong = F.col("question_type").isin(*types) & ~F.col("response_code_display").eqNullSafe(F.col("response_text"))
    return joined.filter(~F.coalesce(wrong, F.lit(False)))


def maybe_active(joined: DataFrame) -> DataFrame:
    """Without the top-level answers that have no question: no data map holds them, so ``drop_inactive`` would drop them later."""
    return joined.filter(F.col("src_system").isNotNull() | F.col("question_group_id").isNotNull())


def datamap_answers(joined: DataFrame, datamaps: DataFrame, scope: Sequence[str] = _SCOPE) -> DataFrame:
    """Answers without a question take their form's attributes by group path; the rest pass through."""
    on = [*scope, "question_group_id"]
    attributes = [c for c in datamaps.columns if c not in on]
    side = _side(datamaps, on).withColumnsRenamed({c: f"_map_{c}" for c in attributes})
    # Top-level answers match none. They are dealt by their question, next to the answers inside it, and not all to one task.
    path = F.coalesce("question_group_id", "question_id")
    same = F.col("src_system").isNull() & F.col("question_group_id").isNotNull() & _same(scope)
    same = same & (path == F.col("_schema_question_group_id"))
    return joined.join(side, same, "left").select(
        [
            F.coalesce(F.col(c), F.col(f"_map_{c}")).alias(c) if c in attributes else F.col(c)
            for c in joined.columns
        ]
    )


def drop_inactive(joined: DataFrame) -> DataFrame:
    """Answers of forms that are no longer defined go."""
    return joined.filter(F.col("src_system").isNotNull())


def attach_headers(answers: DataFrame, headers: DataFrame) -> DataFrame:
    """Response header URI by (study, form label, subject); every answer is kept."""
    on = ["research_study_id", "questionnaire_label", "response_subject_uri"]
    side = _side(headers.select(*on, "questionnaire_response_uri"), on)
    same = F.lit(True)
    for c in on:
        same = same & (F.col(c) == F.col(f"_schema_{c}"))
    return answers.join(side, same, "left").drop(*[f"_schema_{c}" for c in on])


def assign_group_uri(
    answers: DataFrame, groups: DataFrame | None = None,
    scope: Sequence[str] = ("research_study_id", "questionnaire_uuid", "response_subject_uri"),
) -> DataFrame:
    """Give each answer the URI of the group answer at its path and parent index, for the same subject.

    The group answers are those of ``answers``, or of ``groups``.
    """
    columns = [c for c in answers.columns if c != "response_group_uri"]
    path, index = F.col("question_group_id"), parent_index(F.col("response_index_in_list"))
    is_group = F.col("question_type").isin(*ANSWER_GROUP_TYPES)
    own_path = join_path(F.col("question_group_id"), F.col("question_id"))
    own_index, uri = F.col("response_index_in_list"), F.col("questionnaire_response_item_uri")
    if groups is None:
        # A subject's answers to a form come from one document. They are dealt once and together, so they pack well; a join would
        # deal them by all keys, and group answers twice more. After that a group answer stands once more, under its own path and index.
        owner, hashed = F.col("_owner"), F.xxhash64(*scope).alias("_hash")
        group = F.coalesce(is_group, F.lit(False)) & own_index.isNotNull()
        dealt = answers.select(*columns, group.alias("_group"), F.when(group, uri).alias("_uri")).repartition(*scope)
        twice = F.when(F.col("_group"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
        rows = dealt.select("*", hashed, F.explode(twice).alias("_owner")).select(
            "_hash", "_owner", *scope, *[F.when(~owner, F.col(c)).alias(c) for c in columns if c not in scope],
            F.when(owner, own_path).otherwise(path).alias("_path"), F.when(owner, own_index).otherwise(index).alias("_index"),
            F.when(owner, F.struct("_uri")).alias("_uri"),
        )
        found = F.collect_set("_uri").over(Window.partitionBy("_hash", *scope, "_path", "_index"))
        answered = rows.select(*columns, "_owner", found.alias("_found")).filter(~owner)
        return answered.select(*columns, F.explode_outer("_found").alias("_found")).select(*columns, F.col("_found._uri").alias("response_group_uri"))
    owner = (
        groups.filter(is_group)
        .select(
            *[F.col(c).alias(f"_owner_{c}") for c in scope], own_path.alias("_owner_path"), own_index.alias("_owner_index"),
            uri.alias("_owner_uri"),
        )
        .distinct()
    )
    # Paths and indexes are few, so rows sorted by them first are compared column by column; hashes of all keys are not.
    hashed = [c for c in scope if answers.schema[c].dataType == groups.schema[c].dataType]
    owner = owner.withColumn("_owner_hash", F.xxhash64("_owner_path", "_owner_index", *[f"_owner_{c}" for c in hashed]))
    same = (F.xxhash64(path, index, *hashed) == F.col("_owner_hash")) & (path == F.col("_owner_path")) & (index == F.col("_owner_index"))
    for c in scope:
        same = same & F.col(c).eqNullSafe(F.col(f"_owner_{c}"))
    return answers.join(owner, same, "left").select(*columns, F.col("_owner_uri").alias("response_group_uri"))


LIST_KEY = (
    "response_subject_uri", "questionnaire_label", "question_id", "question_group_id", "response_index_in_list",
)


def stored_list_uris(existing: DataFrame, key: Sequence[str] = LIST_KEY, dealt: Sequence[str] = ()) -> DataFrame:
    """The stored list URI per key; several different rows under one key with an index are an error.

    ``dealt`` are further columns that follow from the key, by which ``existing`` is dealt already.
    """
    grouped = existing.groupBy(*dealt, *key).agg(
        F.count(F.lit(1)).alias("_n"), F.max("response_list_group_uri").alias("_stored_uri")
    )
    uri = F.when(F.col("_n") == 1, F.col("_stored_uri"))
    if "response_index_in_list" in key:
        several = (F.col("_n") > 1) & F.col("response_index_in_list").isNotNull()
        uri = F.when(
            several, F.raise_error(F.lit("several stored list URIs for one answer")).cast("string")
        ).otherwise(uri)
    return grouped.select(*dealt, *[F.col(c).alias(f"_list_{c}") for c in key], uri.alias("_stored_uri"))


def reuse_list_uri(existing: DataFrame, answers: DataFrame, key: Sequence[str] = LIST_KEY) -> DataFrame:
    """Keep the list URI that is stored for the same answer; otherwise leave the new one."""
    columns = [
        F.coalesce(F.col("_stored_uri"), F.col(c)).alias(c) if c == "response_list_group_uri" else F.col(c)
        for c in answers.columns
    ]

    def same(stored: Callable[[str], Column]) -> Column:
        found = F.lit(True)
        for c in key:
            found = found & F.col(c).eqNullSafe(stored(f"_list_{c}"))
        return found

    if any(existing.schema[c].dataType != answers.schema[c].dataType for c in key):  # equal values may have unlike hashes
        return answers.join(stored_list_uris(existing, key), same(F.col), "left").select(*columns)
    # Dealt by one hash, stored rows are grouped and joined after one shuffle; keys of an equal hash are told apart in its row.
    stored = stored_list_uris(existing.withColumn("_hash", F.xxhash64(*key)).repartition("_hash"), key, ["_hash"])
    side = stored.groupBy("_hash").agg(F.collect_list(F.struct(*stored.columns[1:])).alias("_stored"))
    own = F.get(F.filter("_stored", lambda x: same(lambda c: x[c])), F.lit(0))["_stored_uri"]
    joined = answers.withColumn("_hash", F.xxhash64(*key)).join(side, "_hash", "left")
    return joined.withColumn("_stored_uri", own).select(*columns)


def in_index_order(answers: DataFrame, *ties: str) -> DataFrame:
    """Answers ordered by their index path as text, then by ``ties`` (a range-partitioned sort).

    Most answers share a few paths such as ``0``. With ``ties`` that tell answers apart (their URI) a shared path is
    spread over many ranges; without, it is one range, and so one task.
    """
    return answers.orderBy("response_index_in_list", *ties)


def numbered_in_index_order(answers: DataFrame, *ties: str) -> DataFrame:
    """Answers with ``row_number``, their place from 1 in the order of their index path, then of ``ties``.

    Ranges of the whole order are sorted alone and written once (by ``checkpoint``), since ranges are drawn from a sample. Each
    range starts after the rows of those before it: one count for each range is all that is summed in one task.
    """
    order = ["response_index_in_list", *ties]
    ranges = answers.repartitionByRange(*order).sortWithinPartitions(*order).select(
        *answers.columns, F.monotonically_increasing_id().alias("_id")
    ).checkpoint()
    part = F.shiftright("_id", 33)
    sizes = ranges.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # One row for each partition, so it is broadcast.
    place = F.col("_start") + F.col("_id").bitwiseAND((1 << 33) - 1) + 1
    return ranges.withColumn("_part", part).join(F.broadcast(starts), "_part").select(*answers.columns, place.alias("row_number"))


def existing_answers(answers: DataFrame, study: str, subject_type: str) -> DataFrame:
    """Stored answers of one study and level (study, subject or session)."""
    return answers.filter((F.col("research_study_id") == study) & (F.col("response_subject_type") == subject_type))


def answers_in_scope(answers: DataFrame, subjects: DataFrame) -> DataFrame:
    """Stored answers of the studies and levels of ``subjects``: one semi-join before anything is grouped."""
    scope = ["research_study_id", "response_subject_type"]
    # One row for each study and level, so it is broadcast: stored answers are not dealt by so few keys.
    return answers.join(F.broadcast(subjects.select(*scope).distinct()), scope, "left_semi")
