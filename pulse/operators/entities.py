"""Entity mentions by phrase list: whole words, longest match, entity types by whitelist."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import once
from ..settle import settle

# The entity types that are reported.
TYPES = ("PERSON", "ORG", "GPE", "NORP", "PRODUCT", "EVENT", "WORK_OF_ART")


def raw_words(col: Column) -> Column:
    """Words of an uncleaned text: runs of letters and digits, case kept."""
    return F.regexp_extract_all(col, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def mentions_in(
    col: Column, gazetteer: Mapping[str, str], types: Iterable[str] = TYPES
) -> Column:
    """Phrases of a small gazetteer (phrase -> type) found in a text, in text order.

    A match inside a longer one is dropped; repeats stay. Everything happens within the row:
    nothing is exploded or shuffled. For a gazetteer table use :func:`mentions`.
    """
    allowed = set(types)
    phrases = [p for p, t in gazetteer.items() if t in allowed]
    empty = F.array().cast("array<string>")
    if not phrases:
        return empty
    first_words = sorted({p.split(" ")[0] for p in phrases})
    sizes = F.array(*[F.lit(n) for n in sorted({len(p.split(" ")) for p in phrases}, reverse=True)])

    def spans(words: Column) -> Column:
        positions = F.when(F.size(words) > 0, F.sequence(F.lit(1), F.size(words))).otherwise(
            F.array().cast("array<int>")
        )
        starts = F.filter(positions, lambda i: F.element_at(words, i).isin(first_words))
        tried = F.transform(starts, lambda i: F.transform(sizes, lambda n: F.struct(
            (i + n).alias("end"), F.array_join(F.slice(words, i, n), " ").alias("phrase"))))
        return F.filter(F.flatten(tried), lambda s: s["phrase"].isin(phrases)
                        & (s["end"] <= F.size(words) + 1))

    # starts ascend and sizes descend, so a span is covered iff an earlier one ends no sooner
    start = F.struct(F.lit(0).alias("end"), empty.alias("kept"))
    found = F.transform(F.array(raw_words(col)), spans)[0]
    return F.aggregate(
        found, start,
        lambda a, s: F.when(
            s["end"] > a["end"],
            F.struct(s["end"].alias("end"), F.concat(a["kept"], F.array(s["phrase"])).alias("kept")),
        ).otherwise(a),
        lambda a: a["kept"],
    )


def _places(words: Column, field: int, longest: int) -> Column:
    """Every word with its place and those that follow it, as many as the longest phrase has."""
    return F.transform(words, lambda w, i: F.struct(
        F.lit(field).alias("field"), i.alias("start"), w.alias("word"),
        F.array(w, *[F.get(words, i + k) for k in range(1, longest)]).alias("run"),
    ))


#: Which of overlapping matches stay: all that no longer one covers, or a chain from the left without overlap.
OVERLAPS = ("covered", "greedy")


def _found(
    df: DataFrame, key: str, text_cols: Sequence[str], gazetteer: DataFrame, types: Iterable[str], overlap: str
) -> DataFrame:
    """``key`` and ``found``, the matches that stay, in order; every row of ``df`` is there.

    A row without matches is carried by an entry of its own, so that nothing is joined back. Matches meet
    their text in the only exchange by key, and what overlaps is settled within the row.
    """
    if overlap not in OVERLAPS:
        raise ValueError(f"overlap must be one of {', '.join(OVERLAPS)}, not {overlap!r}")
    listed = gazetteer.where(F.col("type").isin(list(types))).select("phrase", "type").distinct()
    listed = settle(listed, "gazetteer")
    size = F.size(F.split("phrase", " "))
    first = listed.groupBy(F.substring_index("phrase", " ", 1).alias("word")).agg(F.collect_set(size).alias("sizes"))
    first = settle(first, "gazetteer-words")
    longest = listed.agg(F.max(size)).first()[0] or 1
    empty = F.array().cast("array<string>")
    places = [_places(F.coalesce(F.col(f"_w{i}"), empty), i, longest) for i in range(len(text_cols))]
    own = F.array(F.struct(F.lit(-1).alias("field"), F.lit(0).alias("start"), F.lit(None).cast("string").alias("word"), empty.alias("run")))
    worded = once(df.select(key, *text_cols), **{f"_w{i}": raw_words(F.col(c)) for i, c in enumerate(text_cols)})
    marker = F.col("field") < 0
    starts = worded.select(key, F.inline(F.concat(own, *places))).join(first, "word", "left").where(marker | F.col("sizes").isNotNull())
    grams = starts.select(key, "field", "start", "run", F.explode_outer("sizes").alias("size"))
    grams = grams.where(marker | F.get("run", F.col("size") - 1).isNotNull()).select(
        key, "field", "start", "size", F.when(~marker, F.array_join(F.slice("run", F.lit(1), F.greatest(F.col("size"), F.lit(1))), " ")).alias("phrase"))
    hits = grams.join(listed, "phrase", "left").where(marker | F.col("type").isNotNull())
    # from the left, the longest first
    cell = F.when(~marker, F.struct("field", "start", (-F.col("size")).alias("minus"), "type", "phrase"))
    gathered = hits.groupBy(key).agg(F.sort_array(F.collect_list(cell)).alias("cells"))

    def step(state: Column, c: Column) -> Column:
        end = c["start"] - c["minus"]
        same = (c["field"] == state["field"]) & (c["start"] == state["start"]) & (end == state["end"])  # of another type
        free = end > state["end"] if overlap == "covered" else c["start"] >= state["end"]
        return F.when(same | (c["field"] != state["field"]) | free, F.struct(
            c["field"].alias("field"), c["start"].alias("start"), end.alias("end"), F.concat(state["kept"], F.array(c)).alias("kept"))).otherwise(state)

    cells = F.array().cast("array<struct<field:int,start:int,minus:int,type:string,phrase:string>>")
    begin = F.struct(F.lit(-1).alias("field"), F.lit(-1).alias("start"), F.lit(-1).alias("end"), cells.alias("kept"))
    return gathered.select(key, F.aggregate("cells", begin, step, lambda state: state["kept"]).alias("found"))


def mentions(
    df: DataFrame, key: str, text_cols: Sequence[str], gazetteer: DataFrame,
    types: Iterable[str] = TYPES, overlap: str = "covered",
) -> DataFrame:
    """``key, field, start, size, phrase, type`` for every mention in the texts of ``text_cols``.

    One way for gazetteers of any size. Places whose word begins no phrase fall out in a join
    with the distinct first words; the others are asked for each length that phrases with that first
    word have, and the phrases made join the gazetteer ``(phrase, type)``. Both tables are
    written first, so that the joins are planned by their true sizes: a small gazetteer is broadcast and
    no word of a text is shuffled. With ``overlap="covered"`` a match inside a longer one of the same text is dropped;
    with ``"greedy"`` the leftmost match, and the longest there, is taken, and the next one begins after it. A text's matches
    must fit in memory. ``key`` must be unique.
    """
    found = _found(df, key, text_cols, gazetteer, types, overlap)
    return found.select(key, F.inline("found")).select(key, "field", "start", (-F.col("minus")).alias("size"), "phrase", "type")


def extract(
    df: DataFrame, key: str, text_cols: Sequence[str], gazetteer: DataFrame,
    types: Iterable[str] = TYPES, overlap: str = "covered",
) -> DataFrame:
    """``key, named_entities``: mentions of all ``text_cols``, column by column, in text order.

    Repeats stay; a row without mentions gets an empty array. ``overlap`` as in :func:`mentions`.
    """
    found = _found(df, key, text_cols, gazetteer, types, overlap)
    return found.select(key, F.col("found.phrase").alias("named_entities"))


def entity_counts(found: DataFrame) -> DataFrame:
    """Mentions per phrase and type."""
    return found.groupBy("phrase", "type").agg(F.count(F.lit(1)).alias("n"))
