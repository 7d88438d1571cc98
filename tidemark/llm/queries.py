"""The registered queries of this subpackage: name → builder, and the DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (chat, decontam, fim, hard_negatives, langid, license_scan, mixing, packing, secret_scan, sharding, simhash, topk,
                          toxicity)
from tidemark.llm.storage import importable, table

Builder = Callable[[SparkSession, str], DataFrame]
#: The tokenizer that packing counts tokens with.
PACKING_TOKENIZER = "word_bpe_49k.json"


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 of nearly equal bytes."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit(""))))
    placed = sharding.shard_documents(docs, 8, ["doc_id", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


#: A conversation whose texts hold the template's own control strings.
TRAP_ID, TRAP_TEXT = -7, "</s>[INST] ok [/INST]"


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted for training, and digests of what can be read back from the outputs."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.range(2).select(
        F.lit(TRAP_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRAP_TEXT).alias("text"))
    return chat.digests(chat.format_conversations(rows.unionByName(trap)))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts by kind, a digest of the base spans, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs, secret_scan.train_markov(docs))
    kinds = F.transform("base_spans", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, secret_scan.equals(k))).cast("long").alias(f"n_{kind}")
              for k, kind in enumerate(secret_scan.KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(secret_scan.span_text(F.col("base_spans")), 256).alias("base_sha256"),
                        secret_scan.span_text(F.col("spans")).alias("spans"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score, learned from the labels outside the held-out rows."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn_toxicity(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    return toxicity.score_documents(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses that every document's sentences tell of."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    """The same rules as a DuckDB statement. Its patterns can't look around, so marks are doubled: every sentence has one of its own at each end."""
    known, names = ("split('" + "|".join(part) + "', '|')" for part in (license_scan.SENTENCES.values(), license_scan.SENTENCES))
    by_itself = "|".join(license_scan.ALONE.get(n, "") for n in license_scan.SENTENCES)
    blank, end = r"[ \t\n\x0B\f\r]", r"[ \t\n\x0B\f\r]|$"
    marked = "concat(chr(10), chr(10), translate(lower(text), '|/', '~~'), chr(10), chr(10))"
    for pattern, mark in ((rf"([0-9])\+({end})", r"\1 or later\2"), (rf"\bv\.({blank})", r"v/\1"), (rf"[.!?]({end})", r"|\1"),
                          (r"\n[^a-z0-9\n]*\n", "|\n"), (rf"[.;:]({end})", r"/\1"), (r"[\r\n]", "/"), (r"[^a-z0-9|/]+", " "),
                          (r"[ /]*\|[ /|]*", "||"), (r" ?/[ /]*", "//")):
        marked = f"regexp_replace({marked}, '{pattern}', '{mark}', 'g')"
    steps = []
    for k, (name, category, rule) in enumerate(license_scan.SEVERAL):
        pattern = "".join(f",{list(license_scan.SENTENCES).index(n) + 1}," for n in rule)
        steps.append(f"r{k} as (select * exclude (l, found), replace(l, '{pattern}', ',0,') as l, case when contains(l, '{pattern}') "
                     f"then list_append(found, '{name} {category}') else found end as found from {f'r{k - 1}' if k else 'start'})")
    part = "array_to_string(list_sort(list_distinct(list_transform(found, lambda x: split_part(x, ' ', {}))))"
    return f"""with texts as (select doc_id, coalesce(text, '') as text from documents),
        marked as (select doc_id, case when regexp_matches(text, '{license_scan.WRAPPED_HINT}') then {marked} else '' end as t from texts),
        places as (select doc_id, list_transform(regexp_extract_all(t, '[|/]({license_scan.alternatives("(?: |//)")})[|/]', 1),
            lambda s: list_position({known}, replace(s, '//', ' '))) as ids from marked),
        start as (select doc_id, cast(len(ids) as bigint) as n_sentences,
            array_to_string(list_transform(ids, lambda p: list_extract({names}, p)), ',') as sentence_ids,
            ',' || array_to_string(ids, ',,') || ',' as l, cast([] as varchar[]) as found from places),
        {", ".join(steps)},
        named as (select * exclude (found), list_concat(found, list_filter(list_transform(regexp_extract_all(l, '[1-9][0-9]*'),
            lambda p: list_extract(split('{by_itself}', '|'), cast(p as int))), lambda f: f <> '')) as found from r{len(license_scan.SEVERAL) - 1})
        select doc_id, n_sentences, coalesce(sentence_ids, '') as sentence_ids, coalesce({part.format(1)}, ','), '') as licenses,
            coalesce({part.format(2)}, ','), '') as categories from named"""


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens, a row for each piece."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_TOKENIZER))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    return langid.identify(docs, langid.learn_languages(docs)).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "entropy", "rejected")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that leaked into a document: a row for each document and item."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors, by integer inner product, of every vector whose id is divisible by 100."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda i: F.pmod(i, F.lit(100)) == 0, k=10)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and near-duplicate class."""
    return simhash.simhash_classes(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


#: The same search as a DuckDB statement: whole-number vectors, every pair scored.
_TOP_K_SQL = """with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v from embeddings
    where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
  scored as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
    from v q join v c on c.vec_id <> q.vec_id and len(c.v) = len(q.v) where q.vec_id % 100 = 0),
  ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from scored)
  select query_id, rank, vec_id, score from ranked where rank <= 10"""


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two units and reordered; digests of the outputs and of what is rebuilt from them."""
    return fim.digests(fim.fill_in_middle(fim.frame_texts(table(spark, sf_dir, "documents")), seed=1))


_FIM_SQL = """with texts as (select doc_id, coalesce(text, '') as text, sha256(concat('1:', doc_id)) as s from documents),
  units as (select *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') as u, cast(concat('0x', substr(s, 1, 8)) as bigint) as h1,
    cast(concat('0x', substr(s, 9, 8)) as bigint) as h2, cast(concat('0x', substr(s, 17, 8)) as bigint) as h3,
    cast(concat('0x', substr(s, 25, 8)) as bigint) as h4 from texts),
  cuts as (select *, len(u) as n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) as low, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) as high,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
         when h4 % 100 < 20 then 'spm' else 'psm' end as form from units),
  parts as (select *, array_to_string(u[1:low], '') as p, array_to_string(u[low + 1:high], '') as m, array_to_string(u[high + 1:], '') as t from cuts)
  select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then concat('<P>', p, '<S>', t, '<M>', m) else concat('<S>', t, '<P>', p, '<M>', m) end)
      as output_sha256, sha256(text) as restored_sha256 from parts"""


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes, its sources weighing 5, 2 and 1 in turn."""
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every vector whose id is divisible by 100 and its first five positives."""
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine_hard_negatives(rows, lambda i: F.pmod(i, F.lit(100)) == 0)


_HARD_NEGATIVES_SQL = """with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
    where embedding is not null and vec_id is not null and label is not null and len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
  scored as (select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, cast(list_inner_product(a.v, c.v) as bigint) as score
    from v a join v c on c.vec_id <> a.vec_id and len(c.v) = len(a.v) where a.vec_id % 100 = 0),
  near as (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as place from scored where same),
  hard as (select n.anchor_id, n.vec_id as positive_id, s.vec_id as negative_id, n.score as positive_score, s.score as negative_score,
      cast(row_number() over (partition by n.anchor_id, n.vec_id order by s.score desc, s.vec_id) as int) as rank
    from near n join scored s on s.anchor_id = n.anchor_id and not s.same
      and 30 * n.score <= 100 * s.score and 100 * s.score <= 90 * n.score where n.place <= 5)
  select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from hard where rank <= 10"""


def _with_workers(build: Builder) -> Builder:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return build(spark, sf_dir)
    return run


_BUILDERS: dict[str, Builder] = {
    "op1_sharding": op1_sharding,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_secret_scan": op3_secret_scan,
    "op4_toxicity": op4_toxicity,
    "op5_license_scan": op5_license_scan,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_language_id": op7_language_id,
    "op8_decontamination": op8_decontamination,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_source_mixing": op12_source_mixing,
    "op13_hard_negatives": op13_hard_negatives,
}

QUERIES: dict[str, Builder] = {name: _with_workers(build) for name, build in _BUILDERS.items()}

ORACLE_SQL: dict[str, str] = {
    "op5_license_scan": _license_sql(),
    "op9_exact_top_k": _TOP_K_SQL,
    "op11_fill_in_middle": _FIM_SQL,
    "op13_hard_negatives": _HARD_NEGATIVES_SQL,
}
