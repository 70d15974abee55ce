"""Document fingerprints by winnowing (Schleimer, Wilkerson, Aiken), in DataFrame expressions only.

A text's units are its characters without white space, in every script, so texts of a few words and
texts without spaces are cut as finely as others. Every run of ``GRAM`` units has a hash; of every
``WINDOW`` consecutive hashes the smallest is marked, the rightmost of equals, and marks keep
their position. So any passage of at least ``GRAM + WINDOW - 1`` units that two texts share leaves
a common mark in both.

The marks of every text are computed once, where it stands behind the document before it. The edited text is a start of the one
and a start of the other, so its marks are theirs, but for the few windows that hold units of both.

A text of fewer units than a gram has one gram of all its units, fewer grams than a window are one
window, and a null, empty or blank text has no mark. Two texts without marks are alike (1). Equal
texts have equal fingerprints. Rows that repeat a doc_id each have their fingerprints, and one of them is
the next document of the row before; rows without a doc_id have no next document and are no one's next.
Other columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import neighbours

#: Units of a gram, grams of a window (a power of two), and the units that a window spans.
GRAM, WINDOW = 5, 4
SPAN = GRAM + WINDOW - 1
#: A mark is hash * PLACES + (PLACES - 1 - position), so that the smallest mark is the rightmost of the smallest hash.
PLACES = 1 << 31
BLANKS = " \t\n\x0b\f\r"


def units(text: Column) -> Column:
    """A text without white space; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def hash_of(mark: Column) -> Column:
    return F.shiftright(mark, 31)


def position_of(mark: Column) -> Column:
    return F.lit(PLACES - 1) - mark.bitwiseAND(PLACES - 1)


def _grams(name: str) -> Column:
    """A mark for every gram of a column of units, in order."""
    def mark(gram: Column, at: Column) -> Column:
        return F.shiftleft(F.xxhash64(gram).bitwiseAND(PLACES - 1), 31).bitwiseOR(F.lit(PLACES - 1) - at)

    # each match consumes one character and captures the gram that begins there
    full = F.transform(F.regexp_extract_all(name, F.lit(f"(?s)(?=(.{{{GRAM}}}))."), F.lit(1)), mark)
    short = F.array(mark(F.col(name), F.lit(0)))
    return F.when(F.length(name) >= GRAM, full).when(F.length(name) > 0, short).otherwise(F.array().cast("array<bigint>"))


def with_marks(df: DataFrame, **marks: str) -> DataFrame:
    """Add columns: for each ``name=units`` the marks of a column of units (see :func:`units`), in order of position.

    Window minima by doubling: the minimum of 2, 4, 8, ... neighbours comes from two of half as many. Several
    columns are marked side by side, as every step passes its rows on as a whole.
    """
    level = lambda name, span: f"_{name}_{span}"
    df = df.withColumns({level(name, 1): _grams(of) for name, of in marks.items()})
    span = 1
    while span < WINDOW:
        def least(name: str, span=span) -> Column:
            of = level(name, span)
            left = F.greatest(F.size(of) - span, F.lit(0))
            least_of_two = F.zip_with(F.slice(of, 1, left), F.slice(of, span + 1, left), lambda a, b: F.least(a, b))
            # fewer grams than a window: its only mark is the least of them all
            return F.when(F.size(of) > span, least_of_two).when(F.size(of) > 0, F.array(F.array_min(of))).otherwise(F.col(of))

        df = df.withColumns({level(name, 2 * span): least(name) for name in marks}).drop(*[level(name, span) for name in marks])
        span *= 2
    df = df.withColumns({name: F.array_distinct(level(name, span)) for name in marks})
    return df.drop(*[level(name, span) for name in marks])


def moved(marks: Column, by: Column) -> Column:
    """The marks as they are ``by`` places further on."""
    return F.transform(marks, lambda mark: mark - by)


def with_edited_marks(df: DataFrame, a: str, p: str, b: str, q: str) -> DataFrame:
    """Add ``edited``: the marks of the first ``p`` units of ``a`` with the first ``q`` of ``b`` behind them. The marks
    of both columns of units are in ``{a}_marks`` and ``{b}_marks``.

    A mark of a text at or before the place where the last whole window of its first p units begins is chosen by
    such a window too. The marks of the windows around that place, and of those that hold units of both
    columns, are found in short cuttings: around the seam, and at the end.
    """
    p, q, none = F.col(p), F.col(q), F.array().cast("array<bigint>")
    back, zero = SPAN - 1 + WINDOW - 1, F.lit(0)
    cut = lambda c, start, stop: F.substring(F.col(c), start + 1, stop - start)
    from_a, from_b = F.greatest(p - back, zero), F.greatest(q - back, zero)
    df = df.withColumns({"_seam": F.concat(cut(a, from_a, p), cut(b, zero, F.least(q, F.lit(SPAN - 1)))), "_end": cut(b, from_b, q)})
    df = with_marks(df, _seam_marks="_seam", _end_marks="_end")
    upto = lambda marks, last: F.filter(marks, lambda mark: mark.bitwiseAND(PLACES - 1) >= F.lit(PLACES - 1) - last)
    first = F.when(p >= SPAN, upto(f"{a}_marks", p - SPAN)).otherwise(none)
    # a cutting that is shorter than a window has no marks of its own, unless it is all there is
    middle = F.when((F.length("_seam") >= SPAN) | (F.length("_seam") == p + q), moved(F.col("_seam_marks"), from_a)).otherwise(none)
    other = F.when(q >= SPAN, moved(upto(f"{b}_marks", q - SPAN), p)).otherwise(none)
    last = F.when(F.length("_end") >= SPAN, moved(F.col("_end_marks"), p + from_b)).otherwise(none)
    return (df.withColumn("edited", F.array_distinct(F.concat(first, middle, other, last)))
            .drop("_seam", "_end", "_seam_marks", "_end_marks"))


def hashes(marks: Column) -> Column:
    """The distinct hashes of marks, without positions."""
    return F.array_distinct(F.transform(marks, hash_of))


def positions(marks: Column) -> Column:
    """(hash, unit position from 0) of each mark."""
    return F.transform(marks, lambda m: F.struct(hash_of(m).alias("hash"), position_of(m).alias("position")))


def digest(marks: Column) -> Column:
    """One string of 128 bits for all marks and their positions."""
    return F.concat(F.hex(F.xxhash64(marks)), F.lit("-"), F.hex(F.xxhash64(F.lit("again"), marks)))


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two fingerprints (distinct hashes); 1 if neither has any."""
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - shared
    return F.when(either == 0, F.lit(1.0)).otherwise(shared / either)


def with_next(known: DataFrame) -> DataFrame:
    """Texts (doc_id not null) with their units and marks, and those of the next document: (text, a, a_marks) and ``next``.

    Adjacent documents form runs of about a million characters. A run is brought together once, with a copy of the
    document that is next to its first; there each text is marked, and the row behind takes its marks over.
    """
    keys = known.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("_first"), F.sum(F.length("text")).alias("_size"))
    near = neighbours(keys, "doc_id", "_size")
    copies = near.where("begins").select(F.col("lower").alias("doc_id"), F.col("run").alias("_run"), (F.col("at") - 1).alias("_at"))
    place = lambda run, at, copy: F.struct(F.col(run).alias("run"), F.col(at).alias("at"), F.lit(copy).alias("copy"))
    here, there = place("run", "at", False), place("_run", "_at", True)
    sent = F.xxhash64("text") == F.col("_first")            # of rows that repeat a doc_id
    placed = (known.join(near.select("doc_id", "_first", "run", "at"), "doc_id").join(copies, "doc_id", "left")
              .select("doc_id", "text", sent.alias("sent"),
                      F.inline(F.when(F.col("_run").isNotNull() & sent, F.array(here, there)).otherwise(F.array(here)))))
    placed = placed.repartition("run").sortWithinPartitions("run", "at").withColumn("a", units(F.col("text")))
    marked = with_marks(placed, a_marks="a")
    before = Window.partitionBy("run").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    taken = F.last(F.when(F.col("sent"), F.struct("text", "a", "a_marks")), ignorenulls=True).over(before)
    return marked.withColumn("next", taken).where(~F.col("copy")).select("doc_id", "text", "a", "a_marks", "next")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text with its last third replaced by the next document's start.

    The next document has the next smaller doc_id (after the last: the first). Of rows that repeat
    a doc_id, the one whose text has the smallest hash is the next document. Only ids are ranged; each
    text moves once to its place in the order of ids and once to the run of documents around it.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    alone = with_marks(rows.where("doc_id is null").withColumn("a", units(F.col("text"))), a_marks="a")
    took = with_next(rows.where("doc_id is not null")).unionByName(alone, allowMissingColumns=True)
    took = took.select("doc_id", "text", "a", "a_marks", F.col("next.text").alias("_next"), F.coalesce("next.a", F.lit("")).alias("b"),
                       F.coalesce("next.a_marks", F.array().cast("array<bigint>")).alias("b_marks"))
    took = took.withColumns({"_next": F.coalesce("_next", F.lit("")), "n_chars": F.length("text").cast("long")})
    third = F.floor(F.col("n_chars") / 3).cast("int")
    kept = F.col("n_chars").cast("int") - third
    start = F.substring(F.col("_next"), F.lit(1), third)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), kept), start)
    took = took.select("doc_id", "n_chars", F.sha2(edited.cast("binary"), 256).alias("edited_sha256"),
                       "a", "a_marks", "b", "b_marks", F.length(units(F.substring(F.col("text"), kept + 1, third))).alias("cut"), F.length(units(start)).alias("q"))
    both = with_edited_marks(took.withColumn("p", F.length("a") - F.col("cut")), "a", "p", "b", "q")
    both = both.select("doc_id", "n_chars", "edited_sha256", digest(F.col("a_marks")).alias("fingerprint"),
                       digest(F.col("edited")).alias("edited_fingerprint"), F.size("a_marks").alias("marks"),
                       hashes(F.col("a_marks")).alias("a"), hashes(F.col("b_marks")).alias("b"), hashes(F.col("edited")).alias("e"))
    return both.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("a"), F.col("e")).alias("near_edited"), likeness(F.col("a"), F.col("b")).alias("near_next"), "marks")
