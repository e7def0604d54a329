"""Line deduplication by overlapping windows of consecutive lines.

Every run of ``window`` consecutive lines of a text is hashed (128 bits); a
window with a word in it that occurs more than once in the corpus is repeated.
Its first occurrence, by smallest id and then line number, stays, and the lines
that any later occurrence covers are removed; overlapping occurrences are
merged by uniting their line positions.  Passages of at least ``window`` lines
are so removed line by line wherever they recur, also inside one text.

Windows are counted with map-side aggregation and joined back only where they
repeat; a window with very many occurrences may be split by adaptive execution.
Texts meet their removed positions on the id and a hash of the text, which stay
the same when a task runs again, however the input is read.

Lines end at \\n and compare without leading and trailing spaces.  Defined
results: a null text stays null, a text with fewer lines than a window stays as
it is, and a text that loses all lines becomes empty; rows with equal id and
text are one document, of which each row loses the same lines; rows with a null
id come last.  Other columns are kept; the two counts replace columns of the
same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomewise.llm.batches import clashes, free_name, quoted
from tomewise.session import reliable

WINDOW_LINES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(lines: Column, window: int) -> Column:
    """An array of the windows' hashes, null for a window without a word."""
    bare = F.transform(lines, lambda x: F.trim(x))

    def hashed(ws: Column, i: Column) -> Column:
        part = F.slice(ws, i + 1, window)
        return F.when(F.exists(part, lambda x: x.rlike(r"[^\s]")),
                      F.struct(F.xxhash64(part).alias("h"), F.xxhash64(F.lit("second"), part).alias("g")))

    # the array of bare lines is bound once by an outer one-element transform
    return F.flatten(F.transform(F.array(bare), lambda ws: F.when(
        F.size(ws) >= window,
        F.transform(F.sequence(F.lit(0), F.size(ws) - window), lambda i: hashed(ws, i)))))


def remove_repeated_windows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            window: int = WINDOW_LINES) -> DataFrame:
    """``df`` with the lines of later occurrences removed from its texts, and
    the columns ``n_lines`` and ``n_removed``."""
    keep = clashes(df, ["n_lines", "n_removed"])
    body, own = F.col(quoted(text_col)), F.col(quoted(id_col))
    found = reliable(df.select(own.alias("id"), F.xxhash64(body).alias("t"),
                               F.posexplode(windows(_lines(body), window)).alias("at", "w"))
                       .where("w is not null").select("id", "t", "at", "w.h", "w.g"))
    place = F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("t"), F.col("at"))
    first = (found.groupBy("h", "g").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1").select("h", "g", "first"))
    # a comparison of expressions deals out both sides for this join alone (see joins.join_once)
    f, o = first.alias("f"), found.alias("o")
    later = (o.join(f, (F.col("o.h").bitwiseXOR(F.lit(1)) == F.col("f.h").bitwiseXOR(F.lit(1)))
                    & (F.col("o.g") == F.col("f.g")))
              .where(~(F.col("o.id").eqNullSafe(F.col("first.id")) & (F.col("o.t") == F.col("first.t"))
                       & (F.col("o.at") == F.col("first.at"))))
              .select("o.id", "o.t", "o.at"))
    lines, mark, gone, of, of_mark = (free_name(df, x) for x in ("_lines", "_mark", "_gone", "_of", "_of_mark"))
    covered = (later.select(F.col("id").alias(of), F.col("t").alias(of_mark),
                            F.explode(F.sequence(F.col("at"), F.col("at") + window - 1)).alias("at"))
                    .groupBy(of, of_mark).agg(F.collect_set("at").alias(gone)))
    lined = df.select(*[F.col(quoted(c)) for c in keep if c != text_col], _lines(body).alias(lines),
                      F.xxhash64(body).alias(mark))
    joined = lined.join(covered, own.eqNullSafe(F.col(of)) & (F.col(mark) == F.col(of_mark)), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    text = F.when(F.col(gone).isNull(), F.array_join(lines, "\n")).otherwise(
        F.array_join(F.transform(left, lambda i: F.col(lines)[i]), "\n"))
    return joined.select(
        *[(text if c == text_col else F.col(quoted(c))).alias(c) for c in keep],
        F.when(F.col(lines).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_removed"))
