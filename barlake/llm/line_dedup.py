"""Line dedup by winnowing over line hashes, in DataFrame functions only.

A document is a sequence of lines; lines without words carry no content of their
own. A line goes when it lies in a run of lines with at least ``min_words`` words
that occurred at an earlier place (smaller doc_id, then line number): whole maximal
runs are deleted, their last lines too.

For every line the window is the shortest run of lines from there that has at least
``min_words`` words, and, the other way, the shortest such run that ends there. Each
window selects the line with the smallest hash as its fingerprint, so two documents
that share a run share windows and are guaranteed to select the same lines in it.
Fingerprints that occur at one position only are dropped; around the others the match
is extended both ways: windows that begin at a line carry it to the left, windows that
end at a line carry it to the right, each joined with its first place. A line of a
shared run with fewer than ``min_words`` words after it in the run ends or lies in a
window that the run's last line closes, so nothing of the run stays. Matched windows
that overlap join to runs. Windows are held to be equal by 96 bits of hash over their
lines' hashes.

No pairs of documents are made: every later window meets its first place through
one grouped minimum, so a passage in a third of all documents costs no more than
any other.

Defined cases: a null text stays null, an empty text stays empty; a document all
of whose lines lie in repeated windows becomes the empty text; a null doc_id comes before all
others; rows that repeat both doc_id and text count as one document and get the
same result; a blank line goes when the lines with words before and after it go; an empty table gives an
empty table; other columns stay, whatever their names. Lines are compared without
the white space at their ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm.common import fresh, table, written

MIN_WORDS = 50
_DOC = ("_id", "_th")


def document_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line with words: document key, position, two hashes, word count."""
    keyed = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("_id"),
        F.xxhash64(F.col(text)).alias("_th"),
        F.col(text).alias("_text"),
    ).where(F.col("_text").isNotNull())
    lines = keyed.select(*_DOC, F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_raw"))
    line = F.regexp_replace("_raw", r"^\s+|\s+$", "")
    return lines.select(
        *_DOC,
        F.col("_pos").alias("pos"),
        F.xxhash64(line).alias("h"),
        F.hash(line).alias("g"),
        F.regexp_count("_raw", F.lit(r"\S+")).cast("long").alias("words"),
    ).where("words > 0").dropDuplicates([*_DOC, "pos"])


def winnowed_windows(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Windows from each line on and up to each line: begin, end, content key, fingerprint."""
    by_pos = Window.partitionBy(*_DOC).orderBy("pos")
    placed = lines.withColumn("finish", F.sum("words").over(by_pos)).withColumn(
        "begin", F.col("finish") - F.col("words")
    ).withColumn("next", F.coalesce(F.lead("pos").over(by_pos), F.col("pos") + 1))
    onward = Window.partitionBy(*_DOC).orderBy("begin").rangeBetween(0, min_words - 1)
    back = Window.partitionBy(*_DOC).orderBy("finish").rangeBetween(1 - min_words, 0)

    def window(frame):
        return F.struct(
            F.min("pos").over(frame).alias("pos"),
            F.max("pos").over(frame).alias("end"),
            F.max("next").over(frame).alias("next"),
            F.xxhash64(F.collect_list(F.struct("h", "g")).over(frame)).alias("key_a"),
            F.hash(F.collect_list(F.struct("h", "g")).over(frame)).alias("key_b"),
            F.min(F.struct("h", "pos")).over(frame).alias("smallest"),
        )

    both = placed.select(
        *_DOC,
        "begin",
        "finish",
        F.max("finish").over(onward).alias("reach"),
        F.min("begin").over(back).alias("origin"),
        window(onward).alias("from_here"),
        window(back).alias("to_here"),
    )
    # a window up to a line that is also the window from its first line is there already
    windows = F.array(
        F.when(F.col("reach") - F.col("begin") >= min_words, F.col("from_here")),
        F.when(F.col("begin") - F.col("origin") >= min_words, F.col("to_here")),
    )
    return both.select(*_DOC, F.inline(F.array_compact(windows))).select(
        *_DOC, "pos", "end", "next", "key_a", "key_b",
        F.col("smallest.h").alias("print"), F.col("smallest.pos").alias("print_pos"),
    )


def repeated_runs(windows: DataFrame) -> DataFrame:
    """Runs of lines whose windows occurred before, one row per document and run."""
    by_pos = Window.partitionBy(*_DOC).orderBy("pos")
    place = F.xxhash64(*_DOC, "print_pos")
    shared = (
        windows.groupBy("print").agg(F.min(place).alias("one"), F.max(place).alias("other"))
        .where("one <> other")
        .select("print")
    )
    candidates = windows.join(shared, "print", "left_semi")
    # a table of its own: a very common passage's places can then be dealt to many tasks
    first = written(
        candidates.groupBy("key_a", "key_b")
        .agg(F.min(F.struct("_id", "_th", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("key_a").alias("first_a"), F.col("key_b").alias("first_b"), "first"),
        "first-places",
    )
    later = candidates.join(
        first, (F.col("key_a") == F.col("first_a")) & (F.col("key_b") == F.col("first_b"))
    ).where(F.struct("_id", "_th", "pos") != F.col("first"))
    # the next line with words, so that runs join over blank lines
    reached = F.max("next").over(by_pos.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.coalesce((F.col("pos") > reached).cast("int"), F.lit(1))
    return (
        later.select(*_DOC, "pos", "end", "next", opened.alias("opened"))
        .withColumn("run", F.sum("opened").over(by_pos))
        .groupBy(*_DOC, "run")
        .agg(F.min("pos").alias("start"), F.max("end").alias("end"))
    )


def delete_repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` with later repeated runs cut from the text; adds n_lines and n_deleted.

    (With the two names lengthened by ``_`` where ``docs`` has them already.)
    """
    n_lines, n_deleted, left_id, left_th = fresh(docs, "n_lines", "n_deleted", "l_id", "l_th")
    windows = winnowed_windows(document_lines(docs, doc_id, text), min_words)
    runs = repeated_runs(written(windows, "windows"))
    deleted = runs.groupBy(*_DOC).agg(
        F.flatten(F.collect_list(F.sequence("start", "end"))).alias("_gone")
    )
    keyed = docs.withColumns(
        {
            left_id: F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))),
            left_th: F.xxhash64(F.col(text)),
        }
    )
    joined = keyed.join(
        deleted,
        (keyed[left_id] == deleted["_id"]) & (keyed[left_th] == deleted["_th"]),
        "left",
    )
    lines = F.split(F.col(text), "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    cut = F.array_join(F.transform(kept, lambda p: F.get(lines, p)), "\n")
    return joined.select(
        *[
            (F.when(F.col("_gone").isNull(), F.col(text)).otherwise(cut).alias(c) if c == text
             else docs[c])
            for c in docs.columns
        ],
        F.coalesce(F.size(lines), F.lit(0)).alias(n_lines),
        F.coalesce(F.size("_gone"), F.lit(0)).alias(n_deleted),
    )


def op5_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its later repeated passages deleted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return delete_repeated_lines(docs).select("doc_id", "n_lines", "n_deleted", "text")


# Two windows are equal when their lines are; the first place is the smallest
# (doc_id, line). A line of a repeated run of 50 words lies in the shortest run of 50
# words from it on or up to the run's end. Lines are counted from 0; regexp_split keeps blank lines.
OP5_SQL = r"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
raw AS (
  SELECT doc_id, unnest(generate_series(0, len(parts) - 1)) AS pos, unnest(parts) AS line
  FROM docs WHERE text IS NOT NULL
),
lines AS (
  SELECT doc_id, pos, regexp_replace(line, '^\s+|\s+$', '', 'g') AS line,
         len(regexp_extract_all(line, '\S+')) AS words
  FROM raw
),
begun AS (
  SELECT *, CAST(sum(words) OVER (PARTITION BY doc_id ORDER BY pos) - words AS BIGINT) AS start_word
  FROM lines WHERE words > 0
),
windows AS (
  SELECT doc_id, pos, start_word,
         string_agg(line, chr(10)) OVER w AS content,
         max(pos) OVER w AS last_pos,
         max(start_word + words) OVER w AS reach
  FROM begun
  WINDOW w AS (PARTITION BY doc_id ORDER BY start_word RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
),
backward AS (
  SELECT doc_id, start_word,
         min(pos) OVER b AS pos, pos AS last_pos,
         string_agg(line, chr(10)) OVER b AS content,
         min(start_word) OVER b AS origin
  FROM (SELECT *, start_word + words AS end_word FROM begun)
  WINDOW b AS (PARTITION BY doc_id ORDER BY end_word RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)
),
whole AS (
  SELECT doc_id, pos, last_pos, content FROM windows WHERE reach >= start_word + 50
  UNION ALL
  SELECT doc_id, pos, last_pos, content FROM backward WHERE start_word >= origin + 50
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, pos) AS place FROM whole
),
covered AS (
  SELECT DISTINCT doc_id, unnest(generate_series(pos, last_pos)) AS pos FROM placed WHERE place > 1
),
beside AS (
  SELECT l.doc_id, l.pos, CASE WHEN l.words > 0 THEN c.pos IS NOT NULL END AS goes
  FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.pos = c.pos
),
gone AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos,
           last_value(goes IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before,
           first_value(goes IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
    FROM beside)
  WHERE before AND after
),
kept AS (
  SELECT r.doc_id, count(*) - count(g.pos) AS n_kept, count(g.pos) AS n_deleted,
         count(*) AS n_lines,
         coalesce(string_agg(CASE WHEN g.pos IS NULL THEN r.line END, chr(10) ORDER BY r.pos), '') AS text
  FROM raw r LEFT JOIN gone g ON r.doc_id = g.doc_id AND r.pos = g.pos
  GROUP BY r.doc_id
)
SELECT d.doc_id, CAST(coalesce(k.n_lines, 0) AS INTEGER) AS n_lines,
       CAST(coalesce(k.n_deleted, 0) AS INTEGER) AS n_deleted, k.text
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
