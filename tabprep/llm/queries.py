"""The registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm.common import body, words
from tabprep.llm.decontaminate import contamination
from tabprep.llm.html_extract import extract_text
from tabprep.llm.jaccard import jaccard_classes
from tabprep.llm.language_id import identify
from tabprep.llm.language_model import score_texts
from tabprep.llm.mix import mix
from tabprep.llm.pii import KINDS, find_spans
from tabprep.llm.quality import COMMON, judge
from tabprep.llm.spelling import variant_groups
from tabprep.llm.suffixes import remove_repeats
from tabprep.llm.toxicity import score_toxicity
from tabprep.llm.shard import shard
from tabprep.llm.whiten import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(label: str, sql: str | None = None):
    def add(fn):
        QUERIES[label] = fn
        if sql is not None:
            ORACLES[label] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{label}.parquet")


def sharded(docs: DataFrame) -> DataFrame:
    """The digest of sharding: no text is moved."""
    light = docs.select(
        "doc_id", (F.octet_length(body()) + 1).cast("bigint").alias("size"), F.crc32(body()).alias("text_crc32"))
    return shard(light).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


@query("op5_hypergeometric_shards")
def op5(spark, sf_dir):
    return sharded(table(spark, sf_dir, "documents"))


OP8_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
OP8_SQL = f"""
with d as (select doc_id, {OP8_WORDS} as w from documents),
i as (select item_id, {OP8_WORDS} as w from benchmark),
iw as (select distinct item_id, least(len(w), 10) as n, w[p : p + least(len(w), 10) - 1] as win
       from i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) r(p) where len(w) > 0),
ns as (select distinct n from iw),
dw as (select doc_id, n, p, w[p : p + n - 1] as win from d, ns, unnest(range(1, len(w) - n + 2)) r(p) where len(w) >= n),
h as (select doc_id, item_id, p, n from dw join iw using (n, win)),
pos as (select doc_id, count(distinct q) as n_hit from h, unnest(range(p, p + n)) r(q) group by doc_id),
its as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
        from h group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join pos using (doc_id) left join its using (doc_id)"""


@query("op8_winnowing", OP8_SQL)
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op9_splitting_tree_mix")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.size(words(body())).cast("bigint").alias("size"))
    return mix(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).cast("bigint").alias("taken"),
        F.array_join(F.col("shards").cast("array<string>"), ",").alias("shards"))


SPACES = "\\x20\\x09-\\x0D"


@query("op1_divergence_rules")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op4_vertical_jaccard")
def op4(spark, sf_dir):
    return jaccard_classes(table(spark, sf_dir, "documents").select("doc_id", "text"), size=4, percent=85)


@query("op2_suffix_dedup")
def op2(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


@query("op6_log_bilinear")
def op6(spark, sf_dir):
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op10_lexicon_automata")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_toxicity(docs, table(spark, sf_dir, "labels"))


@query("op3_wrapper_induction")
def op3(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return extract_text(pages).withColumn("n_chars", F.char_length("text").cast("bigint"))


def joined_spans(column: str):
    parts = F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


@query("op7_boosted_candidates")
def op7(spark, sf_dir):
    found = find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(F.array_remove(F.col("base.kind"), k)) for k in KINDS]
    counts = [(F.size("base") - n).cast("bigint").alias(f"n_{k}") for n, k in zip(counts, KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined_spans("base"), 256).alias("base_sha256"), joined_spans("spans").alias("spans"))


@query("op11_refined_whitening")
def op11(spark, sf_dir):
    found = whiten(table(spark, sf_dir, "embeddings"))
    entries = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "entry")
    return found.select("vec_id", "n", "deviation", "identity_error", entries).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "entry.whitened", "entry.explained", "identity_error")


@query("op13_leader_languages")
def op13(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


OP12_SQL = """
with runs as (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) as r from documents),
t as (select coalesce(cast(doc_id as varchar), '') || ':' as id,
             translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as r, count(*) as n
      from runs where length(r) >= 7 group by all),
c as (select r, n, xor(4294967295, list_reduce(
        list_prepend(4294967295::bigint, list_transform(range(1, strlen(id || r) + 1),
            lambda i: cast('0x' || substr(hex(encode(id || r)), 2 * i - 1, 2) as bigint))),
        lambda a, b: list_reduce(list_prepend(xor(a, b), range(0, 8)),
            lambda x, k: xor(x >> 1, case when x % 2 = 1 then 3988292384::bigint else 0 end)))) as h from t),
d as (select n, case when h % 31 = 0
        then left(r, cast(h % length(r) as int)) || substr(r, cast(h % length(r) as int) + 2) else r end as word from c),
v as (select word, cast(sum(n) as bigint) as n from d where length(word) >= 7 group by word having sum(n) >= 2),
cut as (select word, i, left(word, i - 1) || substr(word, i + 1) as rest from v, unnest(range(1, length(word) + 1)) u(i)),
p as (select a.word, b.word as other from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
      union select c.word, v.word from cut c join v on c.rest = v.word
      union select v.word, c.word from cut c join v on c.rest = v.word),
best as (select p.word, cast(count(*) as bigint) as n_near, arg_min(struct_pack(w := other, n := o.n), (-o.n, encode(other))) as top
         from p join v o on o.word = p.other group by p.word),
f as (select v.word, v.n, coalesce(n_near, 0) as n_near, case when top.n >= 10 * v.n then top.w end as form,
             case when top.n >= 10 * v.n then top.n end as form_n
      from v left join best using (word)),
chain as (with recursive x as (select word, word as now, 0 as step from f
          union all select x.word, f.form, step + 1 from x join f on f.word = x.now where f.form is not null)
          select word, arg_max(now, step) as root from x group by word)
select word, form, root, n, n_near, form_n from f join chain using (word)"""


@query("op12_reduced_neighbourhoods", OP12_SQL)
def op12(spark, sf_dir):
    return variant_groups(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "word", "form", "root", "n", "n_near", "form_n")
