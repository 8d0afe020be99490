"""The operators over the given tables, with the parameters they would have in production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.llm import decontaminate, fill_middle, huffman, licenses, merkle, near_dedup, packing, passages, quality, sharding, token_counts, toxicity, vector_join
from snaplake.llm.common import stored, table
from snaplake.workspace import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.rate(docs, quality.fit(docs, quality.ratings(table(spark, sf_dir, "labels"))))


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = [512, 1024, 2048, 4096, 8192, 32768, 131072]
    docs = table(spark, sf_dir, "documents")
    return token_counts.length_histogram(docs, public_tokenizers.path("byte_bpe_50k.json"), group="lang", limits=limits)


@query
def op3_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.vector_links(table(spark, sf_dir, "embeddings"), least=0.93)


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "llm", "token-ids")
    huffman.write_ids(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return huffman.read_ids(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), size=4096, end_id=1)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents")).drop("b0", "b1")


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), threshold=0.3)


@query
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = sharding.sized(table(spark, sf_dir, "documents"))
    placed = sharding.place(sized, shards=16, key="doc_id", keep=["size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home")


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLES["op12_fill_in_middle"] = """
WITH units AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h,
  regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
drawn AS (SELECT *, len(u) AS n, [('0x' || substr(h, k, 8))::BIGINT FOR k IN [1, 9, 17, 25]] AS r FROM units),
cut AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 90 THEN 'plain'
       WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT doc_id, n, form, t, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
  array_to_string(u[b + 1:], '') AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM parts
"""


@query
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows is checked with a text that someone changed."""
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars"]
    own, changed = (merkle.leaf(*[docs[c] for c in fields], text) for text in (docs["text"], merkle.lower_ascii(docs["text"])))
    tampered = F.crc32(docs["doc_id"].cast("string")) % 3 == 0
    leaves = stored(docs.select("doc_id", "lang", own.alias("leaf"), F.when(tampered, changed).otherwise(own).alias("seen")), "leaves")
    built = merkle.manifest(leaves, group="lang", order=["doc_id"], hash_="leaf")
    found = built.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), merkle.folded(F.col("seen"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def _merkle_sql(levels: int, upper: int) -> str:
    """The same tree for groups of up to ``8 ** levels`` rows and up to ``8 ** upper`` groups."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: f"sha256({' || '.join(map(field, ['doc_id', 'source', 'lang', 'n_chars', text]))})"
    ctes = ["t0 AS (SELECT range AS i, range AS c FROM range(256))"]
    ctes += [f"t{k} AS (SELECT i, xor(c >> 1, 3988292384 * (c & 1)) AS c FROM t{k - 1})" for k in range(1, 9)]
    ctes += [
        "crc AS (SELECT list(c ORDER BY i) AS tab FROM t8)",
        f"""leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf("text")} AS leaf,
  {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS changed,
  xor(4294967295, list_reduce(list_prepend(4294967295, [ascii(d)::BIGINT FOR d IN string_split(doc_id::VARCHAR, '')]),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) % 3 = 0 AS tampered FROM documents, crc)""",
        """b0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
  count(*) OVER (PARTITION BY tree) AS n, leaf AS h FROM leaves)""",
    ]

    def tree(base: str, name: str, depth: int, hash_: str) -> None:
        ctes.append(f"{name}_n0 AS (SELECT tree, place, {hash_} AS h, n FROM {base})")
        for k in range(depth):
            ctes.append(f"{name}_r{k} AS (SELECT tree, place // 8 AS run, list(h ORDER BY place) AS hs, any_value(n) AS n FROM {name}_n{k} GROUP BY ALL)")
            ctes.append(
                f"{name}_n{k + 1} AS (SELECT tree, run AS place, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h,"
                f" (n + 7) // 8 AS n FROM {name}_r{k})"
            )

    def path(base: str, name: str, depth: int) -> str:
        """``base`` with the siblings of each level, as pairs; levels of a single node have none."""
        pairs, joins = [], []
        for k in range(depth):
            slot = f"({base}.place // {8**k}) % 8"
            pairs.append(f"{{'l': array_to_string({name}_r{k}.hs[1:{slot}], ''), 'r': array_to_string({name}_r{k}.hs[{slot} + 2:], ''), 'one': {name}_r{k}.n = 1}}")
            joins.append(f"JOIN {name}_r{k} ON {name}_r{k}.tree = {base}.tree AND {name}_r{k}.run = {base}.place // {8 ** (k + 1)}")
        return f"SELECT {base}.*, [{', '.join(pairs)}] AS path FROM {base} {' '.join(joins)}"

    tree("b0", "g", levels, "h")
    ctes.append(f"tops AS (SELECT '' AS tree, tree AS of_tree, h, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM g_n{levels})")
    tree("tops", "u", upper, "h")
    ctes.append(f"above AS ({path('tops', 'u', upper)})")
    ctes.append(f"below AS ({path('b0', 'g', levels)})")
    ctes.append(
        f"""full_path AS (SELECT doc_id, leaf, above.h AS subroot, (SELECT h FROM u_n{upper}) AS root,
  [p FOR p IN list_concat(below.path, above.path) IF NOT p.one] AS path, CASE WHEN tampered THEN changed ELSE leaf END AS seen
  FROM below JOIN above ON above.of_tree = below.tree)"""
    )
    ctes.append("f0 AS (SELECT *, seen AS f FROM full_path)")
    for k in range(levels + upper):
        ctes.append(f"f{k + 1} AS (SELECT * REPLACE (CASE WHEN len(path) > {k} THEN sha256(path[{k + 1}].l || f || path[{k + 1}].r) ELSE f END AS f) FROM f{k})")
    return (
        "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, root, sha256(array_to_string([p.l || p.r FOR p IN path], '')) AS proof_sha256,
  f AS folded_root, f = root AS verified FROM f{levels + upper}"""
    )


ORACLES["op13_manifest"] = _merkle_sql(levels=7, upper=3)
