"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeep.llm import (
    blob_ledger,
    byte_pairs,
    disclosure,
    fill_in_middle,
    filter_audit,
    harmonic,
    jaccard_join,
    line_rules,
    multi_index,
    token_counts,
    token_frames,
    weak_labels,
    web_archive,
)
from rollkeep.llm.common import documents, hex_sha256
from rollkeep.session import prepare
from rollkeep.sources.staging import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(prepare(spark), sf_dir)

        QUERIES[name] = prepared
        if sql:
            ORACLES[name] = sql
        return prepared

    return add


@query("op1_multi_index")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


@query("op2_byte_pair_round_trip")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_pairs.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op3_disclosure")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked, name = disclosure.sanitise(documents(spark, sf_dir).select("doc_id", "text"), keep_text=False)
    number = lambda kind: F.size(F.filter(F.col(name)["base"], lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = _listed(F.col(name)["base"])
    return marked.select("doc_id", *map(number, disclosure.KINDS), hex_sha256(listed).alias("base_sha256"), _listed(F.col(name)["spans"]).alias("spans"))


@query("op4_token_frames")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-frames")
    return token_frames.read(token_frames.write(documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json")))


@query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = new_folder(spark, "token-counts")
    return token_counts.token_counts(documents(spark, sf_dir), cache, public_tokenizers.path("word_bpe_49k.json"))


@query("op6_weak_labels")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return weak_labels.score(docs, weak_labels.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query("op7_harmonic_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonic.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_jaccard_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(documents(spark, sf_dir))[0].select("doc_id", "n_shingles", "component_id")


@query("op9_line_first_cleaning")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked, name = line_rules.with_line_rules(documents(spark, sf_dir).select("doc_id", "text"))
    wanted = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept n_failed_lines lost_chars".split()
    return checked.select("doc_id", *[F.col(f"{name}.{x}") for x in wanted])


@query("op10_blob_ledger")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = blob_ledger.scan(documents(spark, sf_dir), new_folder(spark, "blob-ledger"))
    return found.select(
        "doc_id",
        *[F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in blob_ledger.BASE],
        hex_sha256(blob_ledger.described(blob_ledger.BASE)).alias("base_sha256"),
        blob_ledger.described(blob_ledger.RULES).alias("spans"),
    )


# The orders as a list of five letters that differ; each filter's bit is its place among them.
AUDIT_SQL = r"""
with judged as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
    from documents
),
firsts as (select text, min(doc_id) as least from judged group by text),
flags as (
    select j.doc_id, part,
           (len(words) < 50)::int as a,
           (100 * len(list_distinct(words)) < 65 * len(words))::int as b,
           (100 * length(regexp_replace(j.text, '[^A-Z]', '', 'g')) > 5 * length(j.text))::int as c,
           regexp_matches(j.text, '[#$%&*|]')::int as d,
           coalesce(j.doc_id > least, false)::int as e
    from judged j join firsts f on j.text = f.text
),
said as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
masks as (
    select part, [a, b, c, d, e] as failed, a + b + c + d + e as n_failed, count(*) as n,
           coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
    from flags left join said using (doc_id)
    group by all
),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
filter_orders as (
    select p.x || q.x || r.x || s.x || t.x as filter_order
    from letters p, letters q, letters r, letters s, letters t
    where len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
),
steps as (
    select filter_order, unnest([1, 2, 3, 4, 5])::int as step,
           list_transform(string_split(filter_order, ''), lambda l: ascii(l) - 64) as places
    from filter_orders
),
placed as (
    select filter_order, step, part, n, good, toxic, n_failed, failed[places[step]] = 1 as fails,
           list_sum(list_transform(places[1:step - 1], lambda k: failed[k])) as earlier
    from steps, masks
)
select part, filter_order, step,
       sum(case when coalesce(earlier, 0) = 0 and not fails then n else 0 end)::bigint as kept,
       sum(case when coalesce(earlier, 0) = 0 and fails then n else 0 end)::bigint as removed,
       sum(case when earlier > 0 and fails then n else 0 end)::bigint as redundant,
       sum(case when fails and n_failed = 1 then n else 0 end)::bigint as unique_fails,
       sum(case when coalesce(earlier, 0) = 0 and fails then good else 0 end)::bigint as good_lost,
       sum(case when coalesce(earlier, 0) = 0 and fails then toxic else 0 end)::bigint as toxic_lost,
       sum(case when fails then n * 120 // n_failed else 0 end)::bigint as shapley
from placed
group by part, filter_order, step
"""


@query("op11_filter_audit", AUDIT_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


ARCHIVE_SQL = """
with payloads as (select page_id, coalesce(html, '') as payload from pages),
digested as (
    select page_id, payload, sha1(payload) as hex, max(page_id) over (partition by payload) as largest from payloads
),
-- 5 hexadecimal digits are 4 digits to the base 32
letters as (
    select *, list_transform(range(32), lambda i:
        ('0x' || substr(hex, (5 * (i // 4) + 1)::int, 5))::int // [32768, 1024, 32, 1][(i % 4 + 1)::int] % 32) as digits
    from digested
)
select page_id, strlen(payload)::bigint as payload_bytes,
       array_to_string(list_transform(digits, lambda d: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (d + 1)::int, 1)), '') as payload_digest,
       case when page_id is not distinct from largest then 'response' else 'revisit' end as record_type,
       case when page_id is distinct from largest then largest end as refers_to
from letters
"""


@query("op12_web_archive", ARCHIVE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    files = web_archive.write(pages, new_folder(spark, "web-archive"))
    return web_archive.pages_of(web_archive.read(spark, files))


MIDDLE_SQL = r"""
with units as (
    select doc_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u,
           sha256('42:' || coalesce(doc_id::varchar, '')) as hex
    from documents
),
drawn as (
    select doc_id, text, u, len(u) as n,
           list_transform([1, 9, 17, 25], lambda k: ('0x' || substr(hex, k::int, 8))::bigint) as h
    from units
),
cuts as (
    select *, least(h[1] % (n + 1), h[2] % (n + 1)) as low, greatest(h[1] % (n + 1), h[2] % (n + 1)) as high,
           case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h[3] % 100 >= 50
                then 'plain' when h[4] % 100 < 80 then 'spm' else 'psm' end as form
    from drawn
),
parts as (
    select doc_id, text, n, form, array_to_string(u[1:low], '') as prefix, array_to_string(u[low + 1:high], '') as middle,
           array_to_string(u[high + 1:], '') as suffix
    from cuts
)
select doc_id, n::bigint as n, form,
       case when form <> 'plain' then length(prefix) end::bigint as prefix_chars,
       case when form <> 'plain' then length(middle) end::bigint as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from parts
"""


@query("op13_fill_in_middle", MIDDLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.fill_in_middle(fill_in_middle.stored_frames(documents(spark, sf_dir)))
