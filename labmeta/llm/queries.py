"""The operators over whole tables, with their SQL where it can be written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labmeta.llm import fingerprints as fp
from labmeta.llm import alignment, column_suffix, decontam, fim, gated_lm, language_mix, line_crf, near_dedup, packing, secret_scan
from labmeta.llm import substring_dedup, token_rollup
from labmeta.llm.registry import query, table
from labmeta.sources.tables import shared_folder

_WORD = r"'[^\x20\x09-\x0D]+'"


def span_text(found: str, kinds: tuple[str, ...] | None = None):
    kept = F.filter(found, lambda s: s["kind"].isin(*kinds)) if kinds else F.col(found)
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


_PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]{32,}",
    "pem": r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/= \t\r\n]+-----END [A-Z ]*PRIVATE KEY-----",
}
_LEAST = {
    "assign": f"length(regexp_extract(m, '{_PATTERNS['assign']}', 2)) >= 8", "access": "length(m) >= 16", "hex": "true", "pem": "true",
}
_OP1_SQL = "with d as (select doc_id, coalesce(text, '') as text from documents), " + ", ".join(
    f"""{k}_l as (select doc_id, regexp_extract_all(text, '{p}') as ms, string_split_regex(text, '{p}') as ps from d),
    {k} as (select doc_id, '{k}' as kind, {i} as rank, m, s, s + length(m) as e from (
      select doc_id, ms[i] as m, cast(list_sum(list_transform(ps[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0) as bigint) as s
      from (select *, unnest(range(1, len(ms) + 1)) as i from {k}_l)) where {_LEAST[k]})"""
    for i, (k, p) in enumerate(_PATTERNS.items())
) + """, every as (from assign union all from access union all from hex union all from pem),
  found as (select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
    count(*) filter (kind = 'hex') as n_hex,
    coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (kind <> 'pem'), '') as base,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) as spans from every group by doc_id)
  select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
    sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join found using (doc_id)"""


@query(_OP1_SQL)
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets_of(table(spark, sf_dir, "documents"), shared_folder(spark))
    number = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[number(k) for k in secret_scan.KINDS], F.sha2(span_text("found", secret_scan.KINDS), 256).alias("base_sha256"),
        span_text("found").alias("spans"),
    )


@query()
def op2_gated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out_of_sample = language_mix.remainder("doc_id", 10) == 0
    scored = gated_lm.score_documents(table(spark, sf_dir, "documents"), ~out_of_sample)
    return scored.withColumn("held_out", out_of_sample)


@query()
def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    left = language_mix.remainder("doc_id", 4)
    found = language_mix.identify(docs, docs.filter(left != 2))
    return found.select("doc_id", (left == 2).alias("held_out"), "lang_pred", "score")


def quality_weights(spark: SparkSession, sf_dir: str, docs: DataFrame):
    """Weights learned from the labelled documents whose id's remainder is not 0."""
    labels = table(spark, sf_dir, "labels").filter(language_mix.remainder("doc_id", 5) != 0)
    return line_crf.learn(docs.select("doc_id", "text"), labels.select("doc_id", F.col("quality").alias("label")))


#: Documents of a lower score are rejected.
ACCEPTED = 0.3


@query()
def op5_line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = line_crf.with_quality(docs.select("doc_id", "text"), quality_weights(spark, sf_dir, docs))
    return scored.select(
        "doc_id", (language_mix.remainder("doc_id", 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= ACCEPTED, 1).otherwise(0).alias("predicted"),
    )


@query(f"""
  with w as (select doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) as w from documents),
  win as (select doc_id, i, array_to_string(w[i:i + 19], ' ') as s
          from (select *, unnest(range(1, len(w) - 18)) as i from w where len(w) >= 20)),
  first as (select s, min(row(doc_id, i)) as f from win group by s),
  cut as (select distinct doc_id, unnest(range(i, i + 20)) as p from win join first using (s) where row(doc_id, i) > f),
  kept as (select doc_id, w[p] as word, p from (select *, unnest(range(1, len(w) + 1)) as p from w) anti join cut using (doc_id, p)),
  texts as (select doc_id, string_agg(word, ' ' order by p) as t, count(*) as n from kept group by doc_id)
  select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
    sha256(coalesce(t, '')) as kept_sha256 from w left join texts using (doc_id)""")
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), 20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def tokenizer() -> str:
    """The path of the tokenizer file in the installed package, which executors have too."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer(), packing.CAPACITY, F.crc32("ids").alias("ids_crc32"))


@query(f"""
  with recursive w as (
    select doc_id, list_transform(regexp_extract_all(coalesce(text, ''), {_WORD}),
      lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as w from documents),
  s as (select distinct doc_id, array_to_string(w[i:i + 2], ' ') as s
        from (select *, unnest(range(1, greatest(len(w) - 1, 2))) as i from w where len(w) > 0)),
  n as (select doc_id, count(*) as n from s group by doc_id),
  pairs as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by all),
  links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
  sym as (select a, b from links union all select b, a from links),
  reach as (select doc_id as node, doc_id as root from documents union select sym.b, root from reach join sym on sym.a = node)
  select d.doc_id, coalesce(n.n, 0) as n_shingles, r.c as component_id, d.doc_id = r.c as kept
  from documents d join (select node, min(root) as c from reach group by node) r on r.node = d.doc_id left join n on n.doc_id = d.doc_id""")
def op9_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fp.compared_with_edits(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fp.as_text("kept").alias("fingerprint"),
        fp.as_text("edited_kept").alias("edited_fingerprint"), "near_edited", "near_next",
    )


@query()
def op6_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TOKENS = """
  select *, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as words,
    len(regexp_extract_all(text, '[A-Za-z]+|[0-9]|[^A-Za-z0-9\\x20\\x09-\\x0D]+')) as pieces"""


@query(rf"""
  with now as (
    select d.doc_id, source, lang, case when l.toxic = 1 then regexp_replace(coalesce(text, ''), '[0-9]+', '', 'g')
      else coalesce(text, '') end as text
    from documents d left join labels l on l.doc_id = d.doc_id where coalesce(l.quality, 1) <> 0),
  counted as ({_TOKENS} from now),
  every as (select source, lang, 'words-1' as version, words as n, length(text) as c from counted
            union all select source, lang, 'pieces-1', pieces, length(text) from counted)
  select source, lang, version, count(*) as n_docs, cast(sum(n) as bigint) as n_tokens, cast(sum(c) as bigint) as n_chars
  from every group by all""")
def op4_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in; those of bad quality are withdrawn; toxic ones are revised (no digits); one batch comes twice;
    then a second tokenizer version counts all that is left."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    first, second = {"words-1": token_rollup.word_tokens}, {"pieces-1": token_rollup.piece_tokens}
    no_digits = docs.withColumn("text", F.regexp_replace("text", "[0-9]+", ""))
    marks = labels.filter("quality = 0 or toxic = 1").select(
        "doc_id", F.when(F.col("quality") == 0, "delete").otherwise("upsert").alias("op")
    )

    def fresh(versions) -> DataFrame:
        return token_rollup.counted(docs, versions).withColumn("op", F.lit("upsert"))

    def changes(versions) -> DataFrame:
        return token_rollup.counted(no_digits, versions).join(marks, "doc_id")

    rollup = token_rollup.Rollup(spark, shared_folder(spark)).apply(1, fresh(first))
    rollup = rollup.apply(2, changes(first)).apply(2, changes(first))
    left = fresh(second).join(marks.select("doc_id"), "doc_id", "left_anti").unionByName(changes(second).filter("op = 'upsert'"))
    return rollup.apply(3, left).totals()


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return alignment.align_documents(table(spark, sf_dir, "documents"), *paths, digest)


@query(r"""
  with d as (select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
  u as (select *, case when text = '' then [] else regexp_extract_all(text, '[^\n]*\n|[^\n]+') end as w,
    cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
    cast('0x' || substr(h, 25, 8) as bigint) as h4 from d),
  c as (select *, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) as a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') then 'plain'
      when h4 % 100 < 50 then 'spm' else 'psm' end as form from u),
  p as (select *, array_to_string(w[1:a], '') as prefix, array_to_string(w[a + 1:b], '') as middle,
    array_to_string(w[b + 1:], '') as suffix from c)
  select doc_id, cast(len(w) as bigint) as n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
    case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
      else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
    sha256(text) as restored_sha256 from p""")
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@query()
def op13_column_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = column_suffix.remove_repeated_bytes(table(spark, sf_dir, "documents"), 400)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
