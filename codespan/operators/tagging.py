"""Writing taggings in bulk: from a sheet, by speaker, by phrase, by user code."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codespan.functions.bind import let
from codespan.functions.guard import demand
from codespan.functions import fragments as FR
from codespan.functions.ids import deterministic_id
from codespan.functions.text import running_totals
from codespan.operators.merge import get_or_create, lowest_id_by_name
from codespan.operators.numbering import forward_fill
from codespan.operators.query import filter_sources, require_source_category
from codespan.schemas import CANONICAL
from codespan.session import cut, spread, stored
from codespan.sources.project import shape

Project = dict[str, DataFrame]
SHEET = ["Source", "Source Category", "Node", "Fragment", "Memo"]
SPREAD = 64


def _stamp(rows: DataFrame, user: str, now: datetime) -> DataFrame:
    return shape(
        rows.withColumns(
            {"CreatedBy": F.lit(user), "CreatedDate": F.lit(now), "ModifiedBy": F.lit(user), "ModifiedDate": F.lit(now)}
        ),
        CANONICAL["Tagging"],
    )


def _non_blank(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def sheet_sources(p: Project, sheet: DataFrame, columns: list[Column]) -> DataFrame:
    """Each sheet row with the sources it speaks of.

    A row names a source, a category, both, or neither; with neither it speaks
    of every source.  Such rows are dealt out over slices of the source table,
    so the work stays spread.
    """
    cats = p["SourceCategory"].select(F.col("Id").alias("_cat"), F.col("Name").alias("_cat_name"))
    sources = p["Source"].select(
        F.col("Id").alias("SourceId"), F.col("Name").alias("SourceName"), F.col("Category").alias("_c"), *columns
    ).join(cats, F.col("_c") == F.col("_cat"), "left").drop("_c", "_cat")
    named, by_category = _non_blank("Source"), _non_blank("Source Category")
    by_name = sheet.filter(named).join(
        sources,
        (F.col("Source") == F.col("SourceName"))
        & (~by_category | (F.col("Source Category") == F.col("_cat_name"))),
    )
    in_category = sheet.filter(~named & by_category).join(sources, F.col("Source Category") == F.col("_cat_name"))
    slices = sheet.filter(~named & ~by_category).withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    )
    sliced = sources.withColumn("_s", F.pmod(F.xxhash64("SourceId"), F.lit(SPREAD)).cast("int"))
    everywhere = slices.join(sliced, F.col("_slice") == F.col("_s")).drop("_slice", "_s")
    return by_name.unionByName(in_category).unionByName(everywhere).drop("_cat_name")


def _resolve(p: Project, rows: DataFrame) -> DataFrame:
    """Rows with Fragment, Node, Memo -> one row per node line, with ``Problem``."""
    lines = F.filter(F.split(F.coalesce("Node", F.lit("")), r"\r\n|\r|\n"), lambda x: x != "")
    listed = rows.withColumn("NodeName", F.explode_outer(lines)).filter(
        F.col("NodeName").isNotNull() | _non_blank("Memo")
    )
    ids = lowest_id_by_name(p["Node"]).select(F.col("Name").alias("_n"), F.col("Id").alias("NodeId"))
    found = listed.join(ids, F.col("NodeName") == F.col("_n"), "left").drop("_n")
    problem = F.coalesce(
        FR.fragment_error(F.coalesce("Fragment", F.lit("")), F.col("Length")),
        F.when(F.col("NodeName").isNotNull() & F.col("NodeId").isNull(), F.concat(F.lit("unknown node "), "NodeName")),
    )
    return found.withColumn("Problem", problem)


def _as_taggings(resolved: DataFrame, key: list[str], strict: bool) -> DataFrame:
    if strict:
        message = F.concat(
            F.lit("illegal tagging: "), F.col("Problem"), F.lit(" in "), F.coalesce("Fragment", F.lit("")),
            F.lit(", content length is "), F.coalesce(F.col("Length").cast("string"), F.lit("unknown")),
        )
        good = demand(resolved, F.col("Problem").isNull(), message)
    else:
        good = resolved.filter(F.col("Problem").isNull())
    parts = [F.col(c) for c in ("SourceId", "NodeId", "Fragment", "Memo", *key)]
    return good.select(
        deterministic_id("Tagging", *parts).alias("Id"), F.col("SourceId").alias("Source"),
        F.col("NodeId").alias("Node"), "Fragment", "Memo",
    )


def complete_sheet(sheet: DataFrame, defaults: dict[str, str] | None = None, fill: bool = True) -> DataFrame:
    """All sheet columns, blanks inherited from above and then from the defaults.

    ``sheet`` has a whole-number column ``Row`` giving the order of its rows.
    """
    defaults = defaults or {}
    full = sheet
    for c in SHEET:
        if c not in full.columns:
            full = full.withColumn(c, F.lit(None).cast("string"))
    if fill:
        return forward_fill(full, "Row", SHEET, defaults)
    for c in SHEET:
        full = full.withColumn(c, F.when(_non_blank(c), F.col(c)).otherwise(F.lit(defaults.get(c))))
    return full


def apply_taggings(
    p: Project,
    sheet: DataFrame,
    user: str,
    now: datetime,
    defaults: dict[str, str] | None = None,
    fill: bool = True,
    strict: bool = True,
) -> DataFrame:
    """New tagging rows from a sheet.

    A row with a node tags it (one tagging per line of the cell), one with only
    a memo is an annotation, one with neither does nothing.  ``strict`` fails
    on a fragment outside its text or an unknown node; otherwise such rows are
    left out and :func:`tagging_rejects` lists them.
    """
    rows = sheet_sources(p, complete_sheet(sheet, defaults, fill), [F.length("Content").cast("long").alias("Length")])
    return _stamp(_as_taggings(_resolve(p, rows), ["Row"], strict), user, now)


def tagging_rejects(
    p: Project, sheet: DataFrame, defaults: dict[str, str] | None = None, fill: bool = True
) -> DataFrame:
    """Sheet rows that cannot become taggings, with the problem."""
    rows = sheet_sources(p, complete_sheet(sheet, defaults, fill), [F.length("Content").cast("long").alias("Length")])
    return _resolve(p, rows).filter(F.col("Problem").isNotNull()).select(
        "Row", "SourceName", "NodeName", "Fragment", "Length", "Problem"
    )


def apply_tagging_fn(
    p: Project,
    sheet: DataFrame,
    fn: Callable[[dict, dict], list[dict]],
    user: str,
    now: datetime,
    defaults: dict[str, str] | None = None,
    strict: bool = True,
) -> DataFrame:
    """Taggings a user function makes from a source and a sheet row.

    ``fn(source, row)`` returns dicts with Node, Memo and Fragment.  It runs on
    Arrow batches where the rows are; only this operator sends text to Python.
    """
    columns = list(sheet.columns)
    pairs = sheet_sources(p, complete_sheet(sheet, defaults), [F.col("Content")])
    given = [c for c in columns if c in pairs.columns]

    def call(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            made = []
            for record in batch.to_dict("records"):
                source = {"Id": record["SourceId"], "Name": record["SourceName"], "Content": record["Content"]}
                for i, item in enumerate(fn(source, {c: record[c] for c in given}) or []):
                    made.append(
                        (record["Row"], i, record["SourceId"], record["SourceName"],
                         len(record["Content"] or ""), item.get("Node"), item.get("Fragment"), item.get("Memo"))
                    )
            yield pd.DataFrame(
                made, columns=["Row", "Item", "SourceId", "SourceName", "Length", "Node", "Fragment", "Memo"]
            )

    schema = "Row long, Item long, SourceId string, SourceName string, Length long, Node string, Fragment string, Memo string"
    made = pairs.select(F.col("Row").cast("long").alias("Row"), "SourceId", "SourceName", "Content",
                        *[c for c in given if c != "Row"]).mapInPandas(call, schema)
    return _stamp(_as_taggings(_resolve(p, made), ["Row", "Item"], strict), user, now)


# Fixed value: a line that begins with a name and a colon.
SPEAKER_PATTERN = r"(?mdU)^(.+?):\s*(.*?)$"


def speaker_lines(texts: DataFrame, column: str = "Content") -> DataFrame:
    """Id, Speaker, start0, end0 of what each speaker of a text says.

    Positions come from summing the lengths of the matches and of the text
    between them, so a text is gone through once whatever its length.
    """
    texts = spread(texts.filter(F.col(column).contains(":")), "Id")
    text = F.col(column)
    pattern = F.lit(SPEAKER_PATTERN)
    found = texts.select(
        "Id",
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, pattern, F.lit(1)).alias("name"),
        F.regexp_extract_all(text, pattern, F.lit(2)).alias("said"),
        F.split(text, SPEAKER_PATTERN, -1).alias("between"),
    )
    step = F.transform(
        F.arrays_zip("whole", F.slice("between", 2, F.size("whole")).alias("after")),
        lambda z: (F.length(z["whole"]) + F.length(z["after"])).cast("long"),
    )
    lines = found.withColumn("offset", running_totals(step)).select(
        "Id", F.length(F.element_at("between", 1)).alias("lead"),
        F.explode(F.arrays_zip("whole", "name", "said", "offset")).alias("m"),
    )
    end = F.col("lead") + F.col("m.offset") + F.length("m.whole")
    return lines.select(
        "Id", F.col("m.name").alias("Speaker"),
        (end - F.length("m.said")).alias("start0"), end.alias("end0"),
    )


def tag_speakers(
    p: Project,
    user: str,
    now: datetime,
    node_category: str | None = None,
    source_category: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Taggings of what each speaker says, for speakers that are nodes.

    Of nodes sharing a name the lowest id speaks.  Fragments are zero-based
    with the end left out.
    """
    nodes = p["Node"]
    if node_category is not None:
        wanted = p["NodeCategory"].filter(F.col("Name") == node_category).select(F.col("Id").alias("_c"))
        nodes = nodes.join(wanted, F.col("Category") == F.col("_c"), "left_semi")
    if source_category is not None:
        require_source_category(p, source_category)
    speakers = lowest_id_by_name(nodes).select(F.col("Name").alias("_n"), F.col("Id").alias("Node"))
    texts = filter_sources(p, category=source_category, limit=limit).select("Id", "Content")
    rows = speaker_lines(texts).join(speakers, F.col("Speaker") == F.col("_n")).select(
        F.col("Id").alias("Source"), "Node",
        FR.format_fragment(F.col("start0"), F.col("end0"), base="zero_excl").alias("Fragment"),
    )
    identified = rows.withColumn("Id", deterministic_id("Tagging", F.lit("speaker"), *[F.col(c) for c in rows.columns]))
    return _stamp(identified, user, now)


def duplicate_speakers(nodes: DataFrame) -> DataFrame:
    """Names that more than one node has."""
    return nodes.groupBy("Name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


# Words no phrase contains.
STOP_WORDS = (
    "a an and are as at be but by for from had has have he her his i if in into is it its my no not of on or our "
    "she so that the their them then there these they this to was we were what when which who will with you your"
).split()


def word_pairs(text: Column) -> Column:
    """Default phrase extractor: neighbouring words, neither of them a stop word.

    Works on lower-cased text and never across punctuation or line ends.
    """
    # What is neither word nor blank becomes a word of its own; like a stop word it is null, and so is its pair.
    parted = F.split(F.regexp_replace(text, r"[^\p{L}\p{M} ]+", " . "), " ")
    words = F.transform(F.filter(parted, lambda w: w != ""), lambda w: F.when(~w.isin([*STOP_WORDS, "."]), w))

    def pairs(line: Column) -> Column:
        return F.transform(line, lambda w, i: F.concat(w, F.lit(" "), F.get(line, i + 1)))

    return F.filter(let(words, pairs), lambda pair: pair.isNotNull())


# What ends a sentence, what is cut off its ends, and line ends that a pattern's $ also knows.
_STOPS, _BLANKS, _LINE_ENDS = ".!?\n", " \n", "\r\x85\u2028\u2029"


def _tiles(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"[^.!?\n]+[.!?\n]*"), F.lit(0))


def _odd(text: Column) -> Column:
    """Whether a text has line ends before which blanks are cut off too, which takes a pattern."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in _LINE_ENDS])


def _body(tile: str) -> Column:
    """A tile of a text that is ``odd`` or not, without the blanks around it."""
    return F.when(F.col("odd"), F.regexp_replace(tile, r"^[ \n]+|[ \n]+$", "")).otherwise(F.btrim(tile, F.lit(_BLANKS)))


def sentences(texts: DataFrame, column: str = "Content", also: tuple[str, ...] = (), dealt: bool = False) -> DataFrame:
    """Id, Sentence (lower case), start0, end0, without surrounding blanks; ``also`` columns stay with them.

    Texts that are ``dealt`` out over tasks already are not moved.
    """
    texts = texts if dealt else spread(texts, "Id")
    text = F.col(column)
    lead = F.length(text) - F.length(F.ltrim(text, F.lit(_STOPS)))
    cut = texts.filter(text.isNotNull()).select(
        "Id", *also, lead.alias("lead"), _odd(text).alias("odd"), _tiles(text).alias("tile"))
    sizes = F.transform("tile", lambda t: F.length(t).cast("long"))
    rows = cut.withColumn("offset", running_totals(sizes)).select(
        "Id", *also, "lead", "odd", F.posexplode(F.arrays_zip("tile", "offset")).alias("n", "t")
    )
    start = F.col("lead") + F.col("t.offset")
    before = F.length("t.tile") - F.length(F.ltrim("t.tile", F.lit(_BLANKS)))
    return rows.select(
        "Id", *also, "n", F.lower(_body("t.tile")).alias("Sentence"), (start + before).alias("start0"),
        (start + before + F.length(_body("t.tile"))).alias("end0"),
    ).filter(F.length("Sentence") > 0)


def sentence_texts(texts: DataFrame, column: str = "Content") -> DataFrame:
    """The Sentence column of :func:`sentences` alone, for counts that ask for no places."""
    text = F.col(column)
    cut = spread(texts, "Id").filter(text.isNotNull()).select(_odd(text).alias("odd"), _tiles(text).alias("tiles"))
    return cut.select("odd", F.explode("tiles").alias("tile")).select(_body("tile").alias("_body")).filter(F.length("_body") > 0).select(F.lower("_body").alias("Sentence"))


Extractor = Callable[[Column], Column]
PLACE = ["Source", "start0", "end0"]


def phrase_occurrences(texts: DataFrame, extractor: Extractor = word_pairs) -> DataFrame:
    """One row per phrase of each sentence; ``extractor`` maps a text column to an array.

    It may be native, as the default is, or a pandas UDF around a language tool.
    """
    return sentences(texts).select(
        F.col("Id").alias("Source"), "start0", "end0", F.posexplode(extractor(F.col("Sentence"))).alias("k", "Phrase")
    )


def _runs(texts: DataFrame, longest: int) -> DataFrame:
    """Source, start0, end0 of a sentence, run, k, size, Phrase and times of every phrase of up to ``longest`` words.

    A phrase is made of words that follow each other with nothing but spaces
    between, none of them a stop word; ``k`` is the place of its first one.  A text
    given several times under one Id is taken apart once: its single words occur so
    many ``times``, longer phrases once, a place having one next word.
    """
    texts = texts.groupBy("Id", "Content").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    pieces = F.regexp_extract_all(F.col("Sentence"), F.lit(r"[\p{L}\p{M} ]+"), F.lit(0))
    kept = sentences(texts, also=("copies",)).select(
        F.col("Id").alias("Source"), "start0", "end0", "copies", F.posexplode(pieces).alias("run", "_piece")
    )
    # A stop word is null, and so is every phrase that it would be part of.
    words = F.transform(
        F.filter(F.split("_piece", " +"), lambda w: w != ""), lambda w: F.when(~w.isin(STOP_WORDS), w)
    )

    def from_here(line: Column, i: Column) -> Column:
        ahead = [F.get(line, i + n) for n in range(longest)]
        spaced = [part for word in ahead for part in (F.lit(" "), word)][1:]
        return F.array(*[F.concat(*spaced[: 2 * size - 1]) for size in range(1, longest + 1)])

    begun = kept.select(*PLACE, "run", "copies", F.posexplode(
        let(words, lambda line: F.transform(line, lambda _, i: from_here(line, i)))).alias("k", "_phrases"))
    phrases = begun.select(*PLACE, "run", "copies", "k", F.posexplode("_phrases").alias("size", "Phrase"))
    return phrases.filter(F.col("Phrase").isNotNull()).select(
        *PLACE, "run", "k", "size", "Phrase", F.when(F.col("size") == 0, F.col("copies")).otherwise(1).alias("times")
    )


def run_frequency(texts: DataFrame, threshold: int, longest: int = 4) -> DataFrame:
    """Phrase and n of the runs of one to ``longest`` words that occur ``threshold`` times or more.

    Phrases are added up where the texts are read, and only sums travel.
    """
    return _runs(texts, longest).groupBy("Phrase").agg(F.sum("times").alias("n")).filter(F.col("n") >= threshold)


def frequent_runs(texts: DataFrame, threshold: int, longest: int = 4) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases of one to ``longest`` words: where they stand, and how often each occurs.

    A phrase is a run of neighbouring words without stop words that occurs
    ``threshold`` times or more.  ``occurrences`` (Source, start0, end0 of the
    sentence, run, k, Phrase) keep the longest phrase at a place: one inside a
    longer frequent phrase there is left out.  ``counts`` (Phrase, n) has them all.
    Texts are taken apart for either, since single words take up far more disk
    than texts do.
    """
    counts = cut(run_frequency(texts, threshold, longest))
    found = _runs(texts, longest).join(counts.select("Phrase"), "Phrase", "left_semi")
    # Parts of a frequent phrase are frequent, so one inside a longer one is inside one that
    # has a word more, which begins here or a word before.
    near = Window.partitionBy(*PLACE, "run").orderBy("k").rangeBetween(-1, 0)
    kept = found.withColumn("_most", F.max("size").over(near)).filter(F.col("_most") == F.col("size"))
    each = F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("_")
    return stored(kept.select(*PLACE, "run", "k", "Phrase", each).drop("_")), counts


def _pieces(texts: DataFrame) -> DataFrame:
    """piece (a number), Source, start0, end0 of the sentence, run, copies, line (words, a full stop for a stop word).

    A text given several times under one Id is taken apart once.
    """
    once = texts.repartition("Id").groupBy("Id", "Content").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    runs = F.regexp_extract_all(F.col("Sentence"), F.lit(r"[\p{L}\p{M} ]+"), F.lit(0))
    words = F.transform(
        F.filter(F.split("_piece", " +"), lambda w: w != ""), lambda w: F.when(w.isin(STOP_WORDS), ".").otherwise(w)
    )
    kept = sentences(once, also=("copies",), dealt=True).select(
        F.col("Id").alias("Source"), "start0", "end0", "copies", F.posexplode(runs).alias("run", "_piece")
    )
    return kept.select(*PLACE, "run", "copies", F.array_join(words, " ").alias("line")).filter(
        F.btrim("line", F.lit(". ")) != ""
    ).withColumn("piece", F.monotonically_increasing_id())


def _chains(pieces: DataFrame, threshold: int) -> DataFrame:
    """Longest stretches of frequent words in which every pair of neighbours is frequent, too.

    Columns: those of a place, run, copies, ``k`` of the first word, words.  A frequent
    phrase lies in one of them.
    """
    said = F.transform(F.split("line", " "), lambda w: F.when(w != ".", w))
    words = pieces.select("copies", F.explode(said).alias("w")).filter(F.col("w").isNotNull())
    often = cut(words.groupBy("w").agg(F.sum("copies").alias("n")).filter(F.col("n") >= threshold).select("w"))
    ahead = let(said, lambda line: F.transform(line, lambda w, i: F.struct(w.alias("w"), F.get(line, i + 1).alias("w2"))))
    pairs = pieces.select(F.inline(ahead)).filter(F.col("w").isNotNull() & F.col("w2").isNotNull())
    # Only pairs of frequent words can be frequent, and only they travel.
    hopeful = pairs.join(often, "w", "left_semi").join(often.withColumnRenamed("w", "w2"), "w2", "left_semi")
    linked = cut(hopeful.groupBy("w", "w2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= threshold).select("w", "w2"))

    held = pieces.select("piece", "line").repartition("piece").select("piece", F.posexplode(ahead).alias("k", "_p")).select("piece", "k", "_p.*")
    found = held.join(often, "w", "left_semi").join(linked.withColumn("_link", F.lit(True)), ["w", "w2"], "left")
    along = Window.partitionBy("piece").orderBy("k")
    before = F.lag(F.when(F.col("_link"), F.col("k") + 1)).over(along)
    chains = (
        found.withColumn("_first", (~before.eqNullSafe(F.col("k"))).cast("int"))
        .withColumn("_chain", F.sum("_first").over(along))
        .groupBy("piece", "_chain")
        .agg(F.min("k").alias("k"), F.transform(F.array_sort(F.collect_list(F.struct("k", "w"))), lambda x: x["w"]).alias("words"))
    )
    place = pieces.select("piece", *PLACE, "run", "copies")
    return chains.drop("_chain").join(place, "piece").select(*PLACE, "run", "copies", "k", "words")


def _longest_frequent(lines: DataFrame, threshold: int) -> DataFrame:
    """words and ``kept`` (places and sizes of the frequent phrases inside no longer one) of each chain of three words or more.

    ``lines``: words, n (how often the chain occurs).  The ends of the chains from each of
    their words on are sorted.  A phrase is frequent where ``threshold`` of them in a row
    begin with it, so the first and the last of those tell how long it can be.
    """
    numbered = stored(lines.withColumn("line", F.monotonically_increasing_id()))
    size = F.size("words")
    # A chain that occurs more often than the threshold counts as often as that.
    tails = numbered.select(
        "line", F.least("n", F.lit(threshold)).cast("int").alias("n"),
        F.posexplode(F.transform(F.sequence(F.lit(1), size - 2), lambda i: F.slice("words", i, size))).alias("i", "tail"),
    ).select("line", "i", "tail", F.posexplode(F.array_repeat(F.lit(0), F.col("n"))).alias("copy", "_"))
    tails = tails.withColumns({f"_{j}": F.get("tail", F.lit(j)) for j in range(3)})
    alike = Window.partitionBy("_0", "_1", "_2").orderBy("tail")
    ranked = Window.partitionBy("_0", "_1", "_2").orderBy("_rank")
    last = F.lead("tail", threshold - 1).over(ranked) if threshold > 1 else F.col("tail")
    differs = F.array_position(F.zip_with("tail", "_last", lambda a, b: a.eqNullSafe(b)), False)
    shared = F.when(F.col("_last").isNull(), 0).when(differs == 0, F.size("tail")).otherwise(differs - 1)
    sizes = (
        tails.withColumn("_rank", F.row_number().over(alike)).withColumn("_last", last).withColumn("_shared", shared)
        .withColumn("size", F.max("_shared").over(ranked.rowsBetween(1 - threshold, 0))).filter("copy = 0")
        .groupBy("line").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "size"))), lambda x: F.greatest(x["size"], F.lit(2)).cast("int")).alias("sizes"))
    )
    # The last pair of a chain is frequent.  A phrase is inside a longer one if what begins a word before ends no sooner.
    every = F.concat("sizes", F.array(F.lit(2)))
    at = F.transform(every, lambda size, i: F.struct(i.alias("i"), size.alias("size")))
    outer = F.filter(at, lambda x: (x["i"] == 0) | (F.get(every, x["i"] - 1) <= x["size"]))
    return sizes.join(numbered, "line").select("words", outer.alias("kept"))


def longest_runs(texts: DataFrame, threshold: int) -> DataFrame:
    """Source, start0, end0 of the sentence, run, k, Phrase of the longest frequent phrase at each place.

    A phrase is a run of neighbouring words without stop words, of any length, that occurs
    ``threshold`` times or more; one inside a longer frequent phrase at its place is left out.
    """
    pieces = stored(_pieces(texts))
    chains = stored(_chains(pieces, threshold))
    size = F.size("words")
    short = chains.filter(size < 3)
    times = F.when(size == 1, F.col("copies")).otherwise(1)
    whole = short.select(*PLACE, "run", "k", F.array_join("words", " ").alias("Phrase"), F.explode(F.array_repeat(F.lit(0), times)).alias("_")).drop("_")
    long = chains.filter(size >= 3)
    kept = _longest_frequent(long.groupBy("words").agg(F.count(F.lit(1)).alias("n")), threshold)
    parts = long.join(kept, "words").select(*PLACE, "run", "k", "words", F.inline("kept")).select(
        *PLACE, "run", (F.col("k") + F.col("i")).alias("k"),
        F.array_join(F.slice("words", F.col("i") + 1, F.col("size")), " ").alias("Phrase"),
    )
    return stored(whole.unionByName(parts))


def _frequent(found: DataFrame, threshold: int) -> DataFrame:
    counts = found.groupBy("Phrase").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= threshold) if threshold else counts


def phrase_frequency(texts: DataFrame, threshold: int = 0, extractor: Extractor = word_pairs) -> DataFrame:
    """Count of each phrase over all sentences, those at or above the threshold (0 = all)."""
    found = sentence_texts(texts.select("Id", "Content")).select(F.explode(extractor(F.col("Sentence"))).alias("Phrase"))
    return _frequent(found, threshold)


PHRASE_CATEGORY = "Noun Phrases"


def tag_phrases(
    p: Project,
    user: str,
    now: datetime,
    threshold: int = 0,
    source_category: str | None = None,
    extractor: Extractor | None = word_pairs,
    limit: int | None = None,
    longest: int | None = None,
) -> Project:
    """A node per frequent phrase and a tagging of the sentence per occurrence.

    Without an ``extractor``, phrases are frequent runs of words of any length
    (see :func:`longest_runs`), or of up to ``longest`` words if that is given
    (see :func:`frequent_runs`).  Fragments are zero-based with the end included.
    """
    if source_category is not None:
        require_source_category(p, source_category)
    spark = p["Node"].sparkSession
    texts = filter_sources(p, category=source_category, limit=limit).select("Id", "Content")
    # Texts are taken apart once: what is counted is also what is tagged.
    if extractor is None and longest is None:
        found = longest_runs(texts, max(threshold, 1)).withColumn("k", F.struct("run", "k"))
        frequent = cut(found.select("Phrase").distinct())
    elif extractor is None:
        found, counts = frequent_runs(texts, max(threshold, 1), longest)
        found = found.withColumn("k", F.struct("run", "k"))
        used = found.select("Phrase").distinct()
        frequent = cut(counts.join(used, "Phrase", "left_semi"))
    else:
        found = stored(phrase_occurrences(texts, extractor))
        frequent = cut(_frequent(found, threshold))
    categories, category_ids = get_or_create(
        p["NodeCategory"], spark.createDataFrame([(PHRASE_CATEGORY,)], "Name string"), "NodeCategory", user, now,
        description=None,
    )
    category = category_ids.filter(F.col("Name") == PHRASE_CATEGORY).select(F.min("Id")).scalar()
    inside = p["Node"].withColumn("_c", category).filter(F.col("Category") == F.col("_c")).drop("_c")
    grown, node_ids = get_or_create(
        inside, frequent.select(F.col("Phrase").alias("Name")), f"Node:{PHRASE_CATEGORY}", user, now, description=None,
    )
    new = grown.join(p["Node"].select(F.col("Id").alias("_i")), F.col("Id") == F.col("_i"), "left_anti")
    new = cut(new.withColumn("Category", category).withColumn("Aggregate", F.lit(False)))
    ids = node_ids.join(frequent.select(F.col("Phrase").alias("_f")), F.col("Name") == F.col("_f"), "left_semi")
    rows = found.join(ids.select("Name", F.col("Id").alias("Node")), F.col("Phrase") == F.col("Name")).select(
        "Source", "Node",
        FR.format_fragment(F.col("start0"), F.col("end0"), base="zero_incl").alias("Fragment"),
        F.col("k").cast("string").alias("k"),
    )
    tagged = rows.withColumn("Id", deterministic_id("Tagging", F.lit("phrase"), *[F.col(c) for c in rows.columns]))
    return p | {
        "NodeCategory": categories,
        "Node": p["Node"].unionByName(shape(new, p["Node"].schema)),
        "Tagging": p["Tagging"].unionByName(_stamp(tagged, user, now)),
    }
