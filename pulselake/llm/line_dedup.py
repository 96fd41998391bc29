"""Line deduplication within one edit, by joins of deletion neighbourhoods.

Two lines are within one insertion, deletion or substitution of a character exactly if deleting
one character at most from each gives the same string. So every line emits the hashes of these
strings, equal hashes are joined, the edit distance of the joined lines is verified, and a line
gives way to the earliest one it meets.

Emitting all deletions of all lines would multiply the text by its line length. Most are ruled
out before: the edit lies in one of ``PARTS`` stretches of the line, and what surrounds the
stretch is equal. Lines first emit one hash for each stretch left out, and only those that meet
another line go on, with that stretch alone. A second round halves the stretch twice more. Then
the deletions of what is left are emitted.

For a bound of several edits the lines are divided into one stretch more than that. One of the
stretches is then untouched and stands in the other line, moved by no more than the bound; lines
that share one are compared.

Everything here is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import key_filter, maybe_in
from pulselake.session import stage

#: Stretches that a line, and then a stretch, is divided into.
PARTS = 4
#: The query's rule: characters from which on lines match within ``EDITS``; shorter ones match when equal.
LEAST_CHARS, EDITS = 20, 1
BLANK = " \t\r\x0b\x0c"

PLACE = "struct(doc_id is null as none, doc_id as doc_id, line_no as line_no, text_hash as text_hash)"


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (from 0), text_hash, line without blanks at its ends, h1, h2, place."""
    cut = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    line = F.trim(F.col("raw"), F.lit(BLANK))
    return (
        cut.select("doc_id", "line_no", "text_hash", line.alias("line"))
        .withColumn("h1", F.xxhash64("line"))
        .withColumn("h2", F.xxhash64(F.lit(7), "line"))
        .withColumn("place", F.expr(PLACE))
    )


def _without(context: Column, text: Column, role: Column, part: Column) -> tuple[Column, Column]:
    """Hash of ``text`` with a stretch left out, and the stretch.

    ``role`` is 1 for a text taken as the longer of a pair whose lengths differ by one; its
    stretch is one character longer.
    """
    base = F.char_length(text) - role
    start = F.floor(base * part / PARTS).cast("int")
    stop = F.floor(base * (part + 1) / PARTS).cast("int")
    key = F.xxhash64(context, part, F.substring(text, F.lit(1), start), F.substring(text, stop + role + 1, base - stop))
    return key, F.substring(text, start + 1, stop - start + role)


def _live(rows: DataFrame) -> DataFrame:
    """``rows`` (key, role, one per distinct line) whose key meets another line it can pair with."""
    dealt = rows.repartition("key")  # one exchange serves the counts and the join
    counts = dealt.groupBy("key").agg(
        F.count(F.when(F.col("role") == 0, True)).alias("n0"), F.count(F.when(F.col("role") == 1, True)).alias("n1")
    )
    met = counts.filter("n0 >= 2 or (n0 >= 1 and n1 >= 1)").select(F.col("key").alias("live_key"))
    return dealt.join(met, F.col("key") == F.col("live_key")).drop("live_key")


def distinct_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """h1, h2, the earliest place, and the first round's keys of each distinct line."""
    rows = lines(docs).filter(F.col("line") != "")
    named = []
    for role in (0, 1):
        for part in range(PARTS):
            base = (F.char_length("line") - role).cast("long")
            key, _ = _without(base, F.col("line"), F.lit(role), F.lit(part))
            named.append(F.when(F.char_length("line") >= least_chars, key).alias(f"k{role}{part}"))
    keyed = rows.select("h1", "h2", "place", *named)
    firsts = [F.first(f"k{r}{p}").alias(f"k{r}{p}") for r in (0, 1) for p in range(PARTS)]
    return keyed.groupBy("h1", "h2").agg(F.min("place").alias("place"), *firsts)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (h1, h2, place) with the line standing at the place."""
    places = stage(
        wanted.groupBy("place.doc_id", "place.text_hash").agg(F.collect_set("place.line_no").alias("numbers")),
        "lines-places",
    )
    whole = docs.select(F.col("doc_id").alias("w_id"), "text", F.xxhash64("text").alias("w_hash"))
    whole = maybe_in(whole, "w_hash", key_filter(places, "text_hash")).filter("hit")
    found = places.join(whole, F.col("w_id").eqNullSafe(F.col("doc_id")) & (F.col("w_hash") == F.col("text_hash")))
    raw = found.select("numbers", F.posexplode(F.split("text", "\n")).alias("n", "raw"))
    line = F.trim(F.col("raw"), F.lit(BLANK))
    picked = raw.filter(F.array_contains("numbers", F.col("n"))).select(line.alias("line"))
    return picked.select(F.xxhash64("line").alias("t1"), F.xxhash64(F.lit(7), "line").alias("t2"), "line").distinct()


def links(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """h1, h2, first: lines with an earlier line within one edit, and the earliest such place.

    ``distinct``: a staged result of ``distinct_lines``.
    """
    keys = F.array(
        *[
            F.struct(F.lit(r).alias("role"), F.lit(p).alias("part"), F.col(f"k{r}{p}").alias("key"))
            for r in (0, 1)
            for p in range(PARTS)
        ]
    )
    exploded = distinct.filter(F.col("k00").isNotNull()).select("h1", "h2", F.explode(keys).alias("e"))
    met = stage(_live(exploded.select("h1", "h2", "e.role", "e.part", "e.key")), "lines-met")
    # Text and place of the lines that go on.
    ids = met.select("h1", "h2").distinct()
    able = maybe_in(distinct.select("h1", "h2", "place"), "h1", key_filter(ids, "h1")).filter("hit").drop("hit")
    held = stage(able.join(ids, ["h1", "h2"]), "lines-held")
    texts = _texts(docs, held)
    held = stage(held.join(texts, (F.col("h1") == F.col("t1")) & (F.col("h2") == F.col("t2"))).drop("t1", "t2"), "lines-text")

    _, stretch = _without(F.lit(0), F.col("line"), F.col("role"), F.col("part"))
    first = met.join(held, ["h1", "h2"]).select("h1", "h2", "place", "role", F.col("key").alias("context"), stretch.alias("rest"))
    second = first.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    key, stretch = _without(F.col("context"), F.col("rest"), F.col("role"), F.col("part"))
    second = second.select("h1", "h2", "place", "role", key.alias("key"), stretch.alias("rest"))
    second = stage(_live(second), "stretches-met")

    who = F.struct("place", "h1", "h2")
    gone = F.concat(F.substring("rest", F.lit(1), F.col("i") - 1), F.substring("rest", F.col("i") + 1, F.char_length("rest")))
    removed = (
        second.filter(F.char_length("rest") > 0)
        .withColumn("i", F.explode(F.sequence(F.lit(1), F.char_length("rest"))))
        .select(who.alias("who"), "role", "i", F.xxhash64("key", gone).alias("left"))
    )
    # Equal after deleting at the same position: one substitution apart, every two of them.
    changed = removed.filter("role = 0").select("who", F.xxhash64("left", "i").alias("left"))
    lead = changed.groupBy(F.col("left").alias("l_left")).agg(F.min("who").alias("lead"), F.count(F.lit(1)).alias("n"))
    swaps = changed.join(lead.filter("n > 1"), F.col("left") == F.col("l_left")).filter(F.col("lead") < F.col("who"))
    # Equal to a line as it stands after one deletion.
    whole = second.filter("role = 0").select(who.alias("whole"), F.xxhash64("key", "rest").alias("w_left"))
    drops = removed.filter("role = 1").join(whole, F.col("left") == F.col("w_left"))
    both = swaps.select(F.col("lead").alias("early"), F.col("who").alias("late")).unionByName(
        drops.select(F.least("who", "whole").alias("early"), F.greatest("who", "whole").alias("late"))
    )
    both = both.distinct()
    # A hash only proposes; the strings decide.
    one = held.select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("line").alias("e_line"))
    two = held.select(F.col("h1").alias("l1"), F.col("h2").alias("l2"), F.col("line").alias("l_line"))
    checked = (
        both.join(one, (F.col("early.h1") == F.col("e1")) & (F.col("early.h2") == F.col("e2")))
        .join(two, (F.col("late.h1") == F.col("l1")) & (F.col("late.h2") == F.col("l2")))
        .filter(F.levenshtein("e_line", "l_line", 1) == 1)
    )
    return checked.groupBy(F.col("l1").alias("h1"), F.col("l2").alias("h2")).agg(F.min("early.place").alias("first"))


def links_within(docs: DataFrame, edits: int, least_chars: int = LEAST_CHARS) -> DataFrame:
    """h1, h2, first as ``links``, for lines within ``edits`` edits.

    Lines that share a stretch are compared each with each.
    """
    rows = lines(docs).filter((F.col("line") != "") & (F.char_length("line") >= least_chars))
    known = rows.groupBy("h1", "h2").agg(F.min("place").alias("place"), F.first("line").alias("line"))
    known = stage(known.withColumn("n", F.char_length("line")), "lines-known")
    parts = edits + 1
    start, stop = (f"cast(floor(n * cast({part} as bigint) / {parts}) as int)" for part in ("part", "(part + 1)"))
    dealt = known.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(edits))))
    dealt = dealt.select("h1", "h2", "n", "part", F.expr(f"substring(line, {start} + 1, {stop} - {start})").alias("piece"))
    held = dealt.select(F.struct("h1", "h2").alias("one"), F.xxhash64("n", "part", "piece").alias("key"))
    # The same stretches of every length that a shorter partner can have, moved by up to ``edits``.
    tried = (
        known.withColumnRenamed("n", "own")
        .withColumn("n", F.explode(F.sequence(F.greatest(F.col("own") - edits, F.lit(1)), F.col("own"))))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(edits))))
        .withColumn("start", F.expr(start))
        .withColumn("size", F.expr(f"{stop} - start"))
        .withColumn("at", F.explode(F.sequence(F.col("start") - edits, F.col("start") + edits)))
        .filter("at >= 0 and at + size <= own")
        .select("h1", "h2", "n", "part", F.expr("substring(line, at + 1, size)").alias("piece"))
    )
    tried = tried.select(F.struct("h1", "h2").alias("two"), F.xxhash64("n", "part", "piece").alias("t_key")).distinct()
    pairs = held.join(tried, (F.col("key") == F.col("t_key")) & (F.col("one") != F.col("two"))).select("one", "two").distinct()
    ones = known.select(F.struct("h1", "h2").alias("o"), F.col("place").alias("o_place"), F.col("line").alias("o_line"))
    twos = known.select(F.struct("h1", "h2").alias("t"), F.col("place").alias("t_place"), F.col("line").alias("t_line"))
    near = (
        pairs.join(ones, F.col("one") == F.col("o"))
        .join(twos, F.col("two") == F.col("t"))
        .filter(F.levenshtein("o_line", "t_line", edits).between(1, edits))
    )
    swap = F.col("t_place") < F.col("o_place")
    late = near.select(
        F.when(swap, F.col("one")).otherwise(F.col("two")).alias("late"), F.least("o_place", "t_place").alias("early")
    )
    return late.groupBy(F.col("late.h1").alias("h1"), F.col("late.h2").alias("h2")).agg(F.min("early").alias("first"))


def line_dedup(docs: DataFrame, edits: int = EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row per line: doc_id, line_no, kept, first_doc_id, first_line_no.

    Lines end at \\n and are compared without blanks at their ends. A line gives way when an
    equal line, or one within ``edits`` edits, stands earlier in the order of doc_id (null last) and
    line number; ``first`` is the earliest such place, or the line's own if it is kept. A line
    that gives way can still be the one that a third line gives way to. Lines of under
    ``least_chars`` characters only give way to equal ones (1: no line is too short); blank lines are kept. A null text
    has no line, an empty one a blank line. A repeated row stands at the same place as the
    first and is kept with it; documents that share an id but not a text are ordered by a hash
    of the text. An empty table gives no rows; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    distinct = stage(distinct_lines(docs, least_chars), "lines-distinct")
    found = links(docs, distinct) if edits == 1 else links_within(docs, edits, least_chars)
    near = found.select(F.col("h1").alias("n1"), F.col("h2").alias("n2"), "first")
    near = stage(near, "lines-near")
    asked = maybe_in(distinct.select("h1", "h2", "place"), "h1", key_filter(near, "n1"))
    own = [F.col("h1").alias("d1"), F.col("h2").alias("d2")]
    moved = asked.filter("hit").join(near, (F.col("h1") == F.col("n1")) & (F.col("h2") == F.col("n2")), "left")
    homes = moved.select(*own, F.least("place", F.coalesce("first", "place")).alias("home")).unionByName(
        asked.filter("not hit").select(*own, F.col("place").alias("home"))
    )
    homes = stage(homes, "lines-homes")  # a plain table, so that Spark can split a very common line's rows
    rows = lines(docs).select("doc_id", "line_no", "h1", "h2", "place", (F.col("line") == "").alias("blank"))
    blank = rows.filter("blank").withColumn("home", F.col("place"))
    full = rows.filter("not blank").join(homes, (F.col("h1") == F.col("d1")) & (F.col("h2") == F.col("d2")))
    return full.select(*blank.columns).unionByName(blank).select(
        "doc_id",
        "line_no",
        (F.col("home") == F.col("place")).alias("kept"),
        F.col("home.doc_id").alias("first_doc_id"),
        F.col("home.line_no").alias("first_line_no"),
    )


def clean_texts(docs: DataFrame) -> DataFrame:
    """doc_id, text: the documents without the lines that give way; ids must be unique here."""
    gone = line_dedup(docs).filter(~F.col("kept")).groupBy("doc_id").agg(F.collect_set("line_no").alias("gone"))
    gone = gone.withColumnRenamed("doc_id", "g_id")
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i))
    joined = docs.select("doc_id", "text").join(gone, F.col("doc_id").eqNullSafe(F.col("g_id")), "left")
    return joined.select("doc_id", F.array_join(kept, "\n").alias("text"))
