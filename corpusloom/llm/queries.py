"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import containers, markup, mixing, neardup, pairs, scans, split, stuffing, visual
from corpusloom.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Chunks and the markup languages in them."""
    return markup.found(table(spark, d, "chunks", "id", "text")).distinct()


def p1_clean(spark: SparkSession, d: str) -> DataFrame:
    """Every delivered chunk without markup."""
    return markup.cleaned(table(spark, d, "chunks", "line_no", "text")).select("line_no", "clean", "markup")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Oversized chunks and the kind of boundary at which they fall into stretches."""
    pieces = split.split_oversized(table(spark, d, "chunks", "id", "text", "meta"))
    return pieces.where(F.col("piece") == 1).select("id", "boundary").distinct()


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    """The pieces of oversized chunks."""
    return split.split_oversized(table(spark, d, "chunks", "id", "text", "meta")).dropDuplicates(["id", "piece"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of chunks that share at least 0.7 of their 5-character sequences."""
    return neardup.pairs(table(spark, d, "chunks", "id", "text"))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """Each chunk's class of equal texts, its links and its group."""
    return neardup.groups(table(spark, d, "chunks", "id", "text"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Defective question and answer pairs."""
    return pairs.defects(table(spark, d, "qa_pairs", "pair_id", "question", "answer")).distinct()


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Chunks and cleaning results that look the same but aren't the same characters."""
    return visual.same_looking(table(spark, d, "chunks", "id", "text"), table(spark, d, "clean_results", "result_id", "text"), "id", "result_id")


def p5_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Every chunk and cleaning result in the consistent form."""
    chunks = visual.with_canonical(table(spark, d, "chunks", "line_no", "text"), keep_text=False).withColumn("table", F.lit("chunks"))
    results = visual.with_canonical(table(spark, d, "clean_results", "line_no", "text"), keep_text=False).withColumn("table", F.lit("clean_results"))
    return chunks.unionByName(results)


def _scanned(spark: SparkSession, d: str, *more: str) -> DataFrame:
    return table(spark, d, "chunks").select("id", *more, "text", F.col("meta.source_file").alias("source_file"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Chunks and the kinds of scanning noise in them."""
    return scans.noise(_scanned(spark, d), table(spark, d, "source_files", "source_file", "title", "short_title"))


def p6_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Every delivered chunk without scanning noise."""
    return scans.repaired(_scanned(spark, d, "line_no"), table(spark, d, "source_files", "source_file", "title", "short_title"), key="line_no").select("line_no", "repaired")


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """What each container of 2,048 tokens holds."""
    return containers.filled(containers.fill(table(spark, d, "documents", "doc_id", "text")))


def p7_assigned(spark: SparkSession, d: str) -> DataFrame:
    """The container of each document or piece of one."""
    return containers.fill(table(spark, d, "documents", "doc_id", "text"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """The training order of the mixed sources."""
    return mixing.mix(table(spark, d, "documents", "doc_id", "source", "text"), table(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """The share each source reaches."""
    return mixing.shares(p8_mix(spark, d), table(spark, d, "mix_targets"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Pages made mainly of keywords, links, tags or products."""
    return stuffing.pages(table(spark, d, "documents", "doc_id", "text")).where("stuffed").select("doc_id")


def p9_pages(spark: SparkSession, d: str) -> DataFrame:
    """Every page's measures."""
    return stuffing.pages(table(spark, d, "documents", "doc_id", "text"))


QUERIES = {f.__name__: f for f in (p1_found, p1_clean, p2_found, p2_pieces, p3_found, p3_groups, p4_found, p5_found, p5_canonical, p6_found, p6_repaired, p7_containers, p7_assigned, p8_mix, p8_shares, p9_found, p9_pages)}

SQL = {
    "p2_found": r"""
with long as (select distinct id, text from chunks where length(text) > 1500),
marked as (
  select id,
    regexp_replace(text, '\n([ \x{3000}]*\n)+', chr(1), 'g') as p,
    regexp_replace(text, '\n', chr(1), 'g') as l,
    regexp_replace(regexp_replace(regexp_replace(text, '([。．？！?!])', '\1' || chr(1), 'g'), '\.(\s)', '.' || chr(1) || '\1', 'g'), '\n', chr(1), 'g') as s
  from long),
longest as (
  select id,
    list_max(list_transform(string_split(p, chr(1)), lambda x: length(trim(x, ' 　' || chr(10) || chr(13))))) as p,
    list_max(list_transform(string_split(l, chr(1)), lambda x: length(trim(x, ' 　' || chr(10) || chr(13))))) as l,
    list_max(list_transform(string_split(s, chr(1)), lambda x: length(trim(x, ' 　' || chr(10) || chr(13))))) as s
  from marked)
select id, case when p <= 1400 then 'paragraph' when l <= 1400 then 'line' when s <= 1400 then 'sentence' else 'none' end as boundary
from longest""",
    "p3_found": r"""
with t as (select distinct id, regexp_replace(text, '[\s\x{3000}\x{00A0}\x{2002}-\x{200A}\x{202F}]', '', 'g') as x from chunks where length(text) >= 200),
g as (select distinct id, substr(x, i, 5) as s from (select id, x, unnest(range(1, length(x) - 3)) as i from t)),
n as (select id, count(*) as c from g group by id),
k as (select a.id as id_a, b.id as id_b, count(*) as c from g a join g b on a.s = b.s and a.id < b.id group by all)
select id_a, id_b from k join n na on na.id = id_a join n nb on nb.id = id_b where k.c >= 0.7 * (na.c + nb.c - k.c)""",
}
