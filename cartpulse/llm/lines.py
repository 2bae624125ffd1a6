"""Cross-site boilerplate removal by the distinct-site spread of lines. Built-in functions only.

The spread of a line is the number of distinct sites (``source``) that hold it. Lines are
trimmed of space, tab and carriage return at both ends and compared by 64-bit hash; a null
source is a site of its own. Steps:

1. One aggregation over all lines finds those on at least two sites (smallest site hash below
   the largest) and the smallest doc_id that holds each. Most lines end here.
2. For the rest, HyperLogLog sketches of their sites merge by aggregation, combined
   within each task first, so a line that a third of all rows hold arrives as a few sketches.
3. Estimates within ``BAND`` of the threshold are replaced by exact distinct counts; below or
   above the band the estimate decides (its standard error at ``LG_K`` = 12 is 1.6 %).
4. Boilerplate lines are cut from every document but the first that holds them, so that no
   text disappears altogether.

Every line but a blank one counts. Lines below ``MIN_CHARS`` characters (headings, single words) need
``SHORT_SITES`` sites.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.session import stored

MIN_SITES = 5
MIN_CHARS = 20
SHORT_SITES = 10
LG_K = 12
BAND = 0.2
_EDGE = " \t\r"


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(_EDGE))


def _held(docs: DataFrame) -> DataFrame:
    """(id, mark, site, line, short) once per document and line."""
    trimmed = F.transform(_split(F.col("text")), _trimmed)
    counted = F.filter(trimmed, lambda line: line != "")
    hashed = F.transform(
        counted,
        lambda line: F.struct(
            F.xxhash64(line).alias("line"), (F.char_length(line) < MIN_CHARS).alias("short")
        ),
    )
    return docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64("text").alias("mark"),
        F.xxhash64("source").alias("site"),
        F.inline(F.array_distinct(hashed)),
    )


def boilerplate(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    held: DataFrame | None = None,
    short_sites: int = SHORT_SITES,
) -> DataFrame:
    """(line, first, spread) for lines on at least ``min_sites`` sites, short ones on ``short_sites``; ``first`` is
    the smallest doc_id that holds the line, ``spread`` exact near the threshold and estimated above."""
    held = _held(docs) if held is None else held
    needed = F.when(F.col("short"), F.lit(short_sites)).otherwise(F.lit(min_sites))
    several = stored(
        held.groupBy("line")
        .agg(
            F.min("site").alias("low"),
            F.max("site").alias("high"),
            F.min("id").alias("first"),
            F.min("short").alias("short"),
        )
        .where((F.col("low") < F.col("high")) | (needed <= 1))
        .select("line", "first", needed.alias("needed")),
        "several-sites",
    )
    sites = held.select("line", "site").join(several.select("line"), "line")
    estimated = stored(
        sites.groupBy("line")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("spread"))
        .join(several, "line")
        .where(F.col("spread") >= F.col("needed") * (1 - BAND)),
        "spread",
    )
    near = estimated.where(F.col("spread") <= F.col("needed") * (1 + BAND)).select("line")
    exact = (
        sites.join(near, "line").distinct().groupBy("line").agg(F.count("*").alias("exact"))
    )
    spread = F.coalesce("exact", "spread")
    return (
        estimated.join(exact, "line", "left")
        .where(spread >= F.col("needed"))
        .select("line", "first", spread.alias("spread"))
    )


def marked(docs: DataFrame, min_sites: int = MIN_SITES, short_sites: int = SHORT_SITES) -> DataFrame:
    """Every row of ``docs`` as struct ``doc``, with the array ``cut`` of hashes to remove."""
    held = stored(_held(docs), "lines")
    found = boilerplate(docs, min_sites, held, short_sites)
    spread = stored(found.select("line", "first"), "boilerplate")
    cuts = (
        held.join(spread, "line")
        .where(~F.col("id").eqNullSafe(F.col("first")))
        .groupBy("id", "mark")
        .agg(F.collect_set("line").alias("cut"))
        .select(F.col("id").alias("cut_id"), F.col("mark").alias("cut_mark"), "cut")
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("mark"), F.struct("*").alias("doc")
    )
    match = F.col("id").eqNullSafe(F.col("cut_id")) & (F.col("mark") == F.col("cut_mark"))
    none = F.array().cast("array<bigint>")
    return rows.join(cuts, match, "left").select("doc", F.coalesce("cut", none).alias("cut"))


def _remaining(text: Column, cut: Column) -> Column:
    goes = lambda line: F.array_contains(cut, F.xxhash64(_trimmed(line)))
    kept = F.array_join(F.filter(_split(text), lambda line: ~goes(line)), "\n")
    return F.when(F.size(cut) > 0, kept).otherwise(text)


def without_boilerplate(
    docs: DataFrame, min_sites: int = MIN_SITES, short_sites: int = SHORT_SITES
) -> DataFrame:
    """The rows of ``docs`` with boilerplate lines cut from ``text`` and ``n_chars`` recounted.

    Rows stay, even when no line remains; all columns keep their names and places. A null text
    stays null and an empty one empty; rows without id hold no first place. Repeated rows are
    cut alike. An empty table gives an empty result."""
    text = _remaining(F.col("doc.text"), F.col("cut"))
    changed = marked(docs, min_sites, short_sites).select("doc", text.alias("left"))
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("left").alias("text"))
        elif name == "n_chars":
            same = F.col("left").eqNullSafe(F.col("doc.text"))
            length = F.char_length("left").cast(docs.schema["n_chars"].dataType)
            columns.append(F.when(same, F.col("doc.n_chars")).otherwise(length).alias("n_chars"))
        else:
            columns.append(F.col("doc").getField(name).alias(name))
    return changed.select(*columns)


def query(docs: DataFrame) -> DataFrame:
    """Per document: lines, lines cut, and length and MD5 of what remains."""
    doc, cut = F.col("doc"), F.col("cut")
    text = F.coalesce(_remaining(doc.getField("text"), cut), F.lit(""))
    rows = marked(docs.select("doc_id", "text", "source")).select(
        doc.getField("doc_id").alias("doc_id"),
        F.size(_split(doc.getField("text"))).cast("long").alias("n_lines"),
        F.size(cut).cast("long").alias("lines_cut"),
        text.alias("remaining"),
    )
    return rows.select(
        "doc_id",
        "n_lines",
        "lines_cut",
        F.char_length("remaining").cast("long").alias("remaining_chars"),
        F.md5(F.col("remaining").cast("binary")).alias("remaining_md5"),
    )


SQL = f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS raw FROM documents
), held AS (
  SELECT doc_id, source, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM lines
  WHERE trim(raw, ' ' || chr(9) || chr(13)) <> ''
), spread AS (
  SELECT line, min(doc_id) AS first FROM held GROUP BY line
  HAVING count(DISTINCT coalesce(source, chr(0))) >= CASE WHEN length(line) < {MIN_CHARS} THEN {SHORT_SITES} ELSE {MIN_SITES} END
), cuts AS (
  SELECT doc_id, list(DISTINCT line) AS cut FROM held JOIN spread USING (line)
  WHERE doc_id <> first GROUP BY doc_id
), cut_texts AS (
  SELECT d.doc_id, d.text, coalesce(c.cut, []) AS cut FROM documents d LEFT JOIN cuts c USING (doc_id)
), remaining AS (
  SELECT doc_id, text, cut, array_to_string(list_filter(string_split(coalesce(text, ''), chr(10)),
    lambda l: NOT list_contains(cut, trim(l, ' ' || chr(9) || chr(13)))), chr(10)) AS left_over
  FROM cut_texts
)
SELECT doc_id, len(string_split(coalesce(text, ''), chr(10)))::BIGINT AS n_lines, len(cut)::BIGINT AS lines_cut,
  length(left_over)::BIGINT AS remaining_chars, md5(left_over) AS remaining_md5
FROM remaining
"""
