"""The training-data queries: each operator on its whole table, with the digest columns its contract names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import boilerplate, bytebpe, fim, hyperminhash, mixing, packing, periodic, sketch, tokenstore, toxicity, urlrules, vectors, warcindex
from .common import WORD, read, text_of
from .tokens import tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences along the Hilbert curve."""
    pieces = packing.pack(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_length", "padding"
    )


@query("op2_fingerprints")
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and their edited forms."""
    return sketch.fingerprints(read(spark, sf_dir, "documents"))


@query(
    "op3_line_dedup",
    f"""WITH l AS (SELECT doc_id, source, row_number() OVER () AS r, text FROM documents),
    x AS (SELECT r, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM l),
    d AS (SELECT DISTINCT source, list_sort(list_distinct([trim(s, ' ' || chr(9) || chr(13)) FOR s IN string_split(coalesce(text, ''), chr(10))
      IF trim(s, ' ' || chr(9) || chr(13)) <> ''])) AS page FROM l),
    n AS (SELECT source, count(*) AS site_pages FROM d GROUP BY source),
    c AS (SELECT source, bare, count(*) AS pages FROM (SELECT source, unnest(page) AS bare FROM d) GROUP BY 1, 2),
    b AS (SELECT c.source, bare FROM c JOIN n ON c.source IS NOT DISTINCT FROM n.source
      WHERE pages >= {boilerplate.LEAST_PAGES} AND pages > {boilerplate.RATIO} * site_pages),
    m AS (SELECT x.*, b.bare IS NOT NULL AS gone FROM x LEFT JOIN b
      ON x.source IS NOT DISTINCT FROM b.source AND trim(line, ' ' || chr(9) || chr(13)) = b.bare),
    g AS (SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
      coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM m GROUP BY r)
    SELECT doc_id, source, CASE WHEN l.text IS NULL THEN NULL ELSE g.text END AS text,
      CASE WHEN l.text IS NULL THEN 0 ELSE n_lines END AS n_lines, n_dropped FROM l JOIN g USING (r)""",
)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that are boilerplate of their source; pages of the same lines are one page."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = boilerplate.drop_boilerplate(docs)
    return out.select("doc_id", "source", "text", F.col("lines.total").alias("n_lines"), F.col("lines.dropped").alias("n_dropped"))


@query(
    "op4_url_filter",
    r"""WITH rules(verdict, rule) AS (VALUES {rules}),
    k AS (SELECT verdict, rule, rule[1:strpos(rule, '/') - 1] AS rh, rule[strpos(rule, '/'):] AS rp FROM rules),
    u AS (SELECT page_id, row_number() OVER () AS r, strpos(url, '://') > 0 AS ok, url[strpos(url, '://') + 3:] AS rest FROM pages),
    p AS (SELECT page_id, r, CASE WHEN ok THEN translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
      CASE WHEN ok THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM u),
    f AS (SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
      FROM p JOIN k ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY r)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN f USING (r)""".replace(
        "{rules}", ", ".join(f"('{v}', '{r}')" for v, r in urlrules.RULES)
    ),
)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return urlrules.filter_pages(read(spark, sf_dir, "pages"), urlrules.rule_table(spark))


@query("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document in the mix."""
    plan = mixing.plan(read(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query("op6_token_store")
def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to ORC and read back."""
    path = scratch_path(spark, "token-store")
    tokenstore.write_tokens(read(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"))
    return tokenstore.checksums(tokenstore.with_starts(tokenstore.read_tokens(spark, path)))


@query("op7_embedding_near_dedup")
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return vectors.near_vectors(read(spark, sf_dir, "embeddings"))


@query("op8_minhash_near_dedup")
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return hyperminhash.near_documents(read(spark, sf_dir, "documents"), percent=85).drop("content")


@query(
    "op9_warc",
    f"""WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
    m AS (SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= {warcindex.LEAST_REVISIT} GROUP BY payload_digest)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN page_id < last THEN last END AS refers_to FROM p LEFT JOIN m USING (payload_digest)""",
)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back by the merged index."""
    runs = warcindex.write_archives(read(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    found = warcindex.read_archives(warcindex.merge_index(runs))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def periodic_edit(docs: DataFrame) -> DataFrame:
    """The input that the run contract asks for: of every tenth hash, the words from a drawn one on repeat with a drawn period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    drawn = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all(text_of(), F.lit(f"({WORD})"), F.lit(1)))
    )
    n = F.size("words").cast("long")
    sized = drawn.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    sized = sized.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    whole, first, period = (F.col(c).cast("int") for c in ("n", "a", "p"))
    rounds = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    made = F.concat(F.slice("words", F.lit(1), first), F.flatten(F.array_repeat(F.slice("words", first + 1, period), rounds)))
    edited = F.when(F.col("n") > 0, F.array_join(F.slice(made, F.lit(1), whole), " ")).otherwise(F.col("text"))
    return sized.select("doc_id", edited.alias("text"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, one in ten of them made periodic."""
    found = periodic.periodic_runs(periodic_edit(read(spark, sf_dir, "documents")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.shorter")).alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * -best.shorter div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_byte_bpe")
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents by rank file, and the bytes they decode to."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    both = bytebpe.decode(bytebpe.encode(read(spark, sf_dir, "documents"), path, pattern), path, pattern)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query(
    "op13_fill_in_middle",
    f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{fim.SEED}:' || doc_id) AS hex FROM documents),
    u AS (SELECT doc_id, text, regexp_extract_all(text, '{fim.UNIT}') AS units, [CAST('0x' || hex[8 * k + 1:8 * k + 8] AS UBIGINT) FOR k IN range(4)] AS h FROM d),
    c AS (SELECT doc_id, text, units, len(units) AS n, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS a,
      greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS b, CASE WHEN text = '' OR contains(text, '{fim.PREFIX}') OR contains(text, '{fim.SUFFIX}')
        OR contains(text, '{fim.MIDDLE}') OR h[3] % 100 >= {fim.FIM_PERCENT} THEN 'plain' WHEN h[4] % 100 < {fim.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM u),
    p AS (SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
      array_to_string(units[b + 1:], '') AS suffix FROM c),
    o AS (SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{fim.PREFIX}' || prefix || '{fim.SUFFIX}' || suffix || '{fim.MIDDLE}' || middle
      ELSE '{fim.SUFFIX}' || suffix || '{fim.PREFIX}' || prefix || '{fim.MIDDLE}' || middle END AS output FROM p)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
      CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars, sha256(output) AS output_sha256, sha256(text) AS restored_sha256 FROM o""",
)
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents rearranged for filling in the middle, and the texts rebuilt from that."""
    made = fim.fill_in_middle(read(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored("output", "form"), 256).alias("restored_sha256"),
    )
