import random
import re
from collections import Counter

from pyspark.sql import functions as F

from codespan.operators import tagging as TG


def test_frequent_runs_equal_python_and_write_no_words(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["red", "tea", "the", "cup,", "hot", "big."]) for _ in range(40)) for _ in range(30)]
    found = Counter()
    for text in texts:
        for piece in text.replace(".", ",").split(","):
            words = piece.split()
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    if "the" not in words[i : i + size]:
                        found[" ".join(words[i : i + size])] += 1
    want = {phrase: n for phrase, n in found.items() if n >= 9}
    df = spark.createDataFrame([(f"s{i}", t) for i, t in enumerate(texts)], "Id string, Content string")
    counts = TG.run_frequency(df, 9)
    assert {r.Phrase: r.n for r in counts.collect()} == want
    # The counts come straight from the texts, without a table of words between.
    assert "regexp_extract_all" in counts._jdf.queryExecution().optimizedPlan().toString()
    occurrences, again = TG.frequent_runs(df, 9)
    assert {r.Phrase: r.n for r in again.collect()} == want
    taken = {(r.Source, r.start0, r.run, r.k): r.Phrase for r in occurrences.collect()}
    for (source, start, run, k), phrase in taken.items():
        before = taken.get((source, start, run, k - 1), "")
        assert phrase in want and not before.endswith(" " + phrase)


def test_a_text_given_twice_doubles_its_words_alone(spark):
    df = spark.createDataFrame([("s", "red tea"), ("s", "red tea"), ("t", "red tea")], "Id string, Content string")
    occurrences, counts = TG.frequent_runs(df, 2)
    assert {r.Phrase: r.n for r in counts.collect()} == {"red": 3, "tea": 3, "red tea": 2}
    assert sorted((r.Source, r.Phrase) for r in occurrences.collect()) == [("s", "red tea"), ("t", "red tea")]


def test_pairs_are_counted_without_places_and_equal_the_pattern(spark):
    word = r"[\p{L}\p{M}]"
    stop = rf"(?!(?:{'|'.join(TG.STOP_WORDS)})(?!{word}))"
    pattern = rf"(?<!{word})(?=({stop}{word}++ +{stop}{word}++))"
    rng = random.Random(3)
    bits = ["red", "tea", "the", "them", "Été", "a\u0301b", "cup,", "x1y", ".", "  ", "\n", "\r", "\u2028", "日本 日本", "it's", "!?", "\t"]
    texts = ["", " \r", "..lead one", "red tea \r\n", "tail \r", None] + [
        " ".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(60)]
    df = spark.createDataFrame([(f"s{i}", t) for i, t in enumerate(texts)], "Id string, Content string")
    by_pattern = lambda text: F.regexp_extract_all(F.regexp_replace(text, " +", " "), F.lit(pattern), F.lit(1))
    line = F.col("Sentence")
    for r in TG.sentences(df).select("Sentence", TG.word_pairs(line).alias("got"), by_pattern(line).alias("want")).collect():
        assert r.got == r.want, r
    for own, told in ((TG.word_pairs, by_pattern), (lambda text: F.array(text), lambda text: F.array(text))):
        counts = TG.phrase_frequency(df, extractor=own)
        want = Counter(r.Phrase for r in TG.phrase_occurrences(df, told).collect())
        assert {r.Phrase: r.n for r in counts.collect()} == want
        assert "posexplode" not in counts._jdf.queryExecution().optimizedPlan().toString()
    found = {r.Id: (r.start0, r.end0, r.Sentence) for r in TG.sentences(df).filter("Id in ('s2', 's3', 's4')").collect()}
    assert found == {"s2": (2, 10, "lead one"), "s3": (0, 8, "red tea\r"), "s4": (0, 5, "tail\r")}


def test_longest_runs_of_any_length_equal_python(spark):
    rng = random.Random(5)
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    texts = [passage, f"{passage} nu", f"xi {passage}", "spam " * 17 + "."]
    for _ in range(40):
        words = [rng.choice(["red", "tea", "the", "hot", "big", "cup,"]) for _ in range(rng.randrange(25))]
        texts.append(" ".join(words) + rng.choice(["", ". ", ".\n"]) + rng.choice(["", passage[: rng.randrange(60)], "red tea hot big red tea hot big"]))
    rows = [(f"s{i}", t) for i, t in enumerate(texts)] + [("s0", passage)]
    for threshold in (1, 2, 3, 7):
        pieces = {}
        for r in TG.sentences(spark.createDataFrame(sorted(set(rows)), "Id string, Content string")).collect():
            for run, piece in enumerate(re.findall("[a-z ]+", r.Sentence)):
                pieces[r.Id, r.start0, r.end0, run] = [None if w in TG.STOP_WORDS else w for w in piece.split()]
        copies = Counter(i for i, _ in rows)
        count = Counter()
        at = {}
        for key, words in pieces.items():
            for k in range(len(words)):
                for size in range(1, len(words) - k + 1):
                    phrase = words[k : k + size]
                    if None not in phrase:
                        at[(*key, k, size)] = " ".join(phrase)
                        count[" ".join(phrase)] += copies[key[0]] if size == 1 else 1
        often = {place for place, phrase in at.items() if count[phrase] >= threshold}
        want = Counter()
        for *place, k, size in often:
            if (*place, k, size + 1) not in often and (*place, k - 1, size + 1) not in often:
                want[(*place, k, at[(*place, k, size)])] += copies[place[0]] if size == 1 else 1
        got = TG.longest_runs(spark.createDataFrame(rows, "Id string, Content string"), threshold)
        assert Counter((r.Source, r.start0, r.end0, r.run, r.k, r.Phrase) for r in got.collect()) == want
        assert max(len(key[-1].split()) for key in want) > 4
