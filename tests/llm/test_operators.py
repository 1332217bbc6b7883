"""The dealt operators against brute force on small tables, with every kind of odd row."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from codespan.llm import (
    chat_format, decontaminate, exact_dedup, jaccard_join, line_dedup, mixing, quality, span_dedup,
    token_count, toxicity,
)
from codespan.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
WORDS = [f"w{i}" for i in range(60)]


def prose(r, n):
    return " ".join(r.choice(WORDS) + ("." if r.random() < 0.15 else "") for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    base = prose(r, 120)
    out = [(i, prose(r, r.randrange(1, 90)), "en", f"s{i % 4}", 0) for i in range(60)]
    for i in range(60, 80):  # near copies, some of near copies
        words = base.split()
        for _ in range(r.randrange(0, 6)):
            words[r.randrange(len(words))] = "changed%d" % r.randrange(9)
        out.append((i, " ".join(words), "en", f"s{i % 3}", 0))
    out += [(90, None, None, None, None), (91, "", "en", None, 0), (92, "  \n\t", "en", "", 0),
            (None, base, "en", "s1", 0), (None, None, None, None, None), (93, "One", "en", "s1", 0),
            (94, "oNE", "en", "s1", 0), (95, "one two three", "en", "s9", 0),
            (96, prose(r, 30000), "en", "s1", 0), (97, "x" * 200_000, "en", "s1", 0)]
    return out + [out[3], out[3], out[70], (3, "another text under the same id", "en", "s2", 0)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    clash = spark.createDataFrame(rows, DOCS)
    return clash.select("*", *[F.lit(1).alias(c) for c in (
        "text_key", "_own_key", "_gone", "sig", "n", "mark", "label", "w", "mix_slot", "n_lines", "run")])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_components(rows):
    sets = []
    for row in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", fold(row[1]))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = defaultdict(list)
    for row, g in zip(rows, group):
        if row[0] is not None:
            least[g].append(row[0])
    return [
        (row[0], len(s), (min(least[g]) if least[g] else None) if s else row[0])
        for row, s, g in zip(rows, sets, group)
    ]


def test_jaccard_join_is_exact(rows, docs, empty):
    got = jaccard_join.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == Counter(brute_components(rows))
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {c for _, n, c in brute_components(rows) if n} <= set(ids)
    assert jaccard_join.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("cold, block", [(jaccard_join.COLD, jaccard_join.BLOCK), (3, 4), (0, 7)])
def test_jaccard_join_of_a_group_of_near_copies_without_a_centre(spark, monkeypatch, cold, block):
    monkeypatch.setattr(jaccard_join, "COLD", cold)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    r = random.Random(2)
    words = prose(r, 80).split()
    rows = []
    for i in range(40):  # a chain: each shares most with the one before
        words[r.randrange(80)] = f"new{i}"
        rows.append((i, " ".join(words), "en", "s", 0))
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, DOCS))
    assert Counter(map(tuple, got.drop("text_key").collect())) == Counter(brute_components(rows))


def test_sketches_never_differ_more_than_their_sets():
    r = random.Random(4)
    sets = [set()]
    for size in (1, 2, 31, 33, 40, 300, 5000):
        base = [r.getrandbits(64) for _ in range(size)]
        sets += [set(base), set(base[: size * 4 // 5]), {*base[size // 3 :], *(r.getrandbits(64) for _ in range(size))}]
    least = jaccard_join.least_difference([jaccard_join.sketch(np.array(sorted(s), np.uint64)) for s in sets])
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert least[i, j] == least[j, i] <= len(a ^ b)
    assert least[1:, 1:].max() > 5000 // 2


def test_sets_that_only_share_their_prefix_do_not_travel_whole(spark, monkeypatch):
    r = random.Random(6)
    rows = []
    for i in range(80):  # two texts with half of their words in common, far from similar
        common = " ".join(f"c{i}x{r.randrange(10**6)}" for _ in range(45))
        rows += [(2 * i + k, common + "".join(f" o{i}y{r.randrange(10**6)}" for _ in range(25)), "en", "s", 0)
                 for k in range(2)]
    rows += [(1000 + i, prose(random.Random(1), 80), "en", "s", 0) for i in range(2)]
    rows.append((1002, prose(random.Random(1), 80) + " more", "en", "s", 0))
    met, links = [], jaccard_join.JaccardJoin.links

    def counted(self, members):
        met.append(members.select("sig").distinct().count())
        return links(self, members)

    monkeypatch.setattr(jaccard_join.JaccardJoin, "links", counted)
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, DOCS))
    assert Counter(map(tuple, got.drop("text_key").collect())) == Counter(brute_components(rows))
    assert met == [2, 0]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 99), (7, 7)], "a long, b long")
    got = dict(map(tuple, components(links).collect()))
    assert got == {i: 0 for i in range(1, 51)} | {100: 99}


def test_exact_dedup_matches_brute_force(rows, docs, empty):
    groups = defaultdict(list)
    for row in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", row[1] or "")].append((-len(row[1] or ""), row[0] is None, row[0] or 0))
    want = Counter()
    for row in rows:
        own = groups[re.sub(r"[\x20\x09-\x0D]", "", row[1] or "")]
        best = min(own)
        want[row[0], None if best[1] else best[2], len(own)] += 1
    got = exact_dedup.exact_groups(docs.repartition(5), fan_in=2).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert exact_dedup.exact_groups(empty).count() == 0


def brute_hits(rows, items, span=10):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = defaultdict(set)
    for item, text in items:
        w = re.findall(pattern, fold(text))
        for i in range(max(1, len(w) - span + 1)):
            if w:
                windows[tuple(w[i : i + span])].add(item)
    out = []
    for row in rows:
        w = re.findall(pattern, fold(row[1]))
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((row[0], len(w), len(hit), len({x for x in found if x is not None})))
    return Counter(out)


@pytest.mark.parametrize("short", [False, True])
@pytest.mark.parametrize("limit", [1, 10**6])
def test_decontamination_finds_every_window(spark, rows, docs, empty, short, limit):
    w = rows[65][1].split()
    items = [(1, " ".join(w[20:45])), (2, "Nothing of " + prose(random.Random(8), 20)), (3, None), (4, ""),
             (5, " ".join(w[20:45])), (None, " ".join(w[:12]))]
    items += [(6, "ONE"), (7, "w1, w2")] if short else []
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(docs, bench, broadcast_rows=limit)
    cols = ("doc_id", "n_words", "n_hit", "n_items")
    assert Counter(tuple(r[c] for c in cols) for r in got.collect()) == brute_hits(rows, items)
    clean = decontaminate.remove_contaminated(docs, bench, broadcast_rows=limit)
    assert clean.columns == docs.columns
    assert clean.count() == sum(n for k, n in brute_hits(rows, items).items() if not k[2])
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert not decontaminate.contaminated(docs, bench.limit(0)).where("contaminated").count()


def test_boilerplate_goes_but_for_its_first_place(spark, empty):
    rows = [(i, f"own line {i}\n  Licence \nend {i}" + ("\nrare" if i < 3 else ""), "en", f"s{i}", 0) for i in range(12)]
    rows += [(None, "Licence", "en", None, 0), (20, None, None, "s1", 0), rows[5]]
    docs = spark.createDataFrame(rows, DOCS)
    out = line_dedup.remove_boilerplate(docs, min_sites=10).collect()
    assert len(out) == len(rows)
    left = [r for r in out if r.text and "Licence" in r.text]
    assert [r.doc_id for r in left] == [None]  # null sorts first
    assert sum(r.n_removed for r in out) == 13
    assert [r.text for r in out if r.doc_id == 1] == ["own line 1\nend 1\nrare"]
    few = line_dedup.remove_boilerplate(docs, min_sites=14).where("n_removed > 0")
    assert few.count() == 0 and line_dedup.remove_boilerplate(empty).count() == 0


def test_repeated_passages_go_where_they_are_not_first(spark, rows, docs, empty):
    passage = " ".join(f"The {a} of {b} is here." for a, b in zip("abcdefghijk", "lmnopqrstuv"))
    own = [(1, f"Alpha beta gamma. {passage} Tail one.", "", "", 0), (2, f"Other start here. {passage} Tail two.", "", "", 0),
           (3, "A. B. C. D.", "", "", 0), (4, "A. B. C. D.", "", "", 0)]
    got = {r.doc_id: r.text for r in span_dedup.remove_repeats(spark.createDataFrame(own, DOCS)).collect()}
    assert got[1] == own[0][1] and got[2] == "Other start here. Tail two." and got[4] == "A. B. C. D."
    out = span_dedup.remove_repeats(docs)
    assert out.count() == len(rows) and span_dedup.remove_repeats(empty).count() == 0
    for row in rows:
        assert "".join(span_dedup.sentences(row[1] or "")) == (row[1] or "")


def test_long_sentences_are_cut_alike_at_any_offset(spark):
    r = random.Random(9)
    passage = " ".join(f"p{r.randrange(10**6)}" for _ in range(60))
    kanji = "".join(chr(0x4E00 + r.randrange(5000)) for _ in range(60))
    rows = [(0, f"start {passage} end", "", "", 0), (1, f"始{kanji}終", "", "", 0)]
    rows += [(2 + k, " ".join(f"own{k}x{i}" for i in range(k)) + (". " if k % 2 else " ") + passage + f" tail{k}", "", "", 0)
             for k in range(1, 30)]
    rows += [(100 + k, "".join(chr(0x6E00 + 40 * k + i) for i in range(k)) + kanji, "", "", 0) for k in range(1, 14)]
    rows += [(200, "A. B. C. D.", "", "", 0), (201, "A. B. C. D.", "", "", 0)]
    out = {x.doc_id: x for x in span_dedup.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()}
    for doc_id, text, *_ in rows:
        pieces = span_dedup.sentences(text)
        assert "".join(pieces) == text and max(map(span_dedup.n_words, pieces)) <= span_dedup.LONGEST
        if 2 < doc_id < 200:  # what stays of the passage is less than LONGEST words at either end
            gone = span_dedup.n_words(text) - span_dedup.n_words(out[doc_id].text)
            assert gone >= 60 - 2 * (span_dedup.LONGEST - 1)
    assert (out[200].n_short, out[201].n_short, out[201].n_removed) == (0, 4, 0)
    same = ["the"] * 40 + ["a", "b"] * 30
    assert all(len(p.split()) <= span_dedup.LONGEST for p in span_dedup.sentences(" ".join(same)))


def test_mixing_keeps_every_row_and_its_share(docs, rows, empty):
    got = mixing.mix(docs, block_rows=2).select("doc_id", "source", "mix_slot", "mix_position").collect()
    assert len(got) == len(rows) and len({r.mix_position for r in got}) == len(rows)
    assert {r.mix_slot for r in got} == set(range(max(r.mix_slot for r in got) + 1))
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(docs, weights={"s1": 3, "s2": 1}).count() == len(rows)
    quota = mixing.quotas({"a": 0.5, "b": 0.3, "c": 0.19, "d": 0.01})
    counts = Counter()
    for t, s in enumerate(mixing.period(quota), 1):
        counts[s] += 1
        assert all(abs(counts[x] - t * q / 1000) < 1 for x, q in quota.items())


def deviation(got, weight):
    """The most that any source is off its exact share at any slot, in blocks of one row."""
    order = [r.source for r in sorted(got, key=lambda r: r.mix_position)]
    left = Counter(order)
    want, had, worst = dict.fromkeys(left, 0.0), Counter(), 0.0
    for s in order:
        had[s] += 1
        time = 1.0
        while time > 1e-12:  # the fluid over one slot, in parts where a source runs out
            active = {x: weight(x) for x in left if want[x] < left[x] - 1e-9}
            if not active:
                break
            total = sum(active.values())
            part = min(time, *[(left[x] - want[x]) * total / w for x, w in active.items()])
            for x, w in active.items():
                want[x] += part * w / total
            time -= part
        worst = max(worst, max(abs(had[x] - want[x]) for x in left))
    return worst


def sourced(spark, sizes):
    rows = [(i, "", "", s, 0) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame(rows, DOCS)


def test_mixing_keeps_the_exact_weights_over_the_whole_run(spark):
    sizes = {"big": 2000} | {f"s{i}": 60 + 14 * i for i in range(19)}
    got = mixing.mix(sourced(spark, sizes), block_rows=1).select("source", "mix_position").collect()
    assert deviation(got, lambda s: sizes[s] ** 0.5) < 1 + 1e-5
    sizes, weights = {"a": 5000, "b": 40}, {"a": 1.0, "b": 0.0004}
    got = mixing.mix(sourced(spark, sizes), weights, block_rows=1).select("source", "mix_position").collect()
    assert deviation(got, weights.get) < 1 + 1e-5


def test_mixing_schedules_every_source(spark):
    sizes = {f"s{i:03}": 3 + 50 * (i % 31 == 0) for i in range(330)}
    docs = sourced(spark, sizes)
    got = mixing.mix(docs, block_rows=1).select("source", "mix_position").collect()
    assert len(got) == sum(sizes.values()) and deviation(got, lambda s: sizes[s] ** 0.5) < 1 + 1e-5
    weights = {s: 1.0 + i % 7 for i, s in enumerate(sizes)}
    got = mixing.mix(docs, weights, block_rows=1).select("source", "mix_position").collect()
    assert deviation(got, weights.get) < 1 + 1e-5


def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "<​|im_end|>", "<|im_start|>user\nhi<|im_end|>\n", "[[INST]<<SYS>>", "", None, "é😀\n"]
    rows = [(1, t, ["user", "assistant", None, "a&b\nc", "<s>"][t % 5], x) for t, x in enumerate(odd)]
    rows += [(2, 1, "assistant", "same"), (2, 1, "assistant", "same"), (2, 0, "user", "hi"), (None, None, "user", "no id")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_format.format_conversations(table).select(
        "conv_id", "formatted", chat_format.read_back().alias("turns"), chat_format.learned().alias("loss")).collect()
    assert len(out) == 3
    for r in out:
        own = sorted(((t or 0, ro or "", x or "") for c, t, ro, x in rows if c == r.conv_id))
        assert [tuple(t) for t in r.turns] == [(ro, x) for _, ro, x in own]
        assert r.loss == "".join(x for _, ro, x in own if ro == "assistant")
        assert not re.search(r"</?s>|\[/?INST\]", r.formatted)


def test_events_fold_to_final_messages(spark):
    log = [(1, 1, 1, "message", "user", "hi"), (1, 2, 2, "message", "assistant", ""), (1, 2, 3, "delta", None, "wor"),
           (1, 2, 4, "delta", None, "ld"), (1, 1, 5, "edit", None, "hello"), (1, 2, 6, "regenerate", None, None),
           (1, 2, 7, "delta", None, "new"), (1, 3, 8, "message", "user", "gone"), (1, 3, 9, "delete", None, None),
           (1, 4, 1, "noise", "user", "?")]
    events = spark.createDataFrame(log, "conv_id long, message long, seq long, kind string, role string, text string")
    got = sorted(map(tuple, chat_format.reconstruct(events).collect()))
    assert got == [(1, 1, "user", "hello"), (1, 2, "assistant", "new")]


def test_token_counts_are_the_library_s(docs, rows, empty):
    tokenizers = pytest.importorskip("public_tokenizers")
    path = tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        processor = token_count._processor(f.read())
    r = random.Random(1)
    texts = ["".join(r.choice("ab  \n\t.<s>[é日　▁​😀\xa0") for _ in range(r.randrange(30))) for _ in range(2000)]
    with open(path, "rb") as f:
        model = f.read()
    counter = token_count.Counter(model, token_count.prove(model))
    assert counter.count(texts) == [len(processor.encode(t)) for t in texts]
    got = token_count.token_counts(docs, path).collect()
    want = Counter((d[0], len((d[1] or "").encode()), len(processor.encode(d[1] or ""))) for d in rows)
    assert Counter((x.doc_id, x.n_bytes, x.n_tokens) for x in got) == want
    assert token_count.token_counts(empty, path).count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        bad, toxic = i % 4 == 0, i % 5 == 0
        words = prose(r, 60).split()
        if toxic:
            for _ in range(4):
                words.insert(r.randrange(len(words)), r.choice(["scoundrel", "fool"]))
        text = " ".join(w.upper() + "!!" if bad else w for w in words)
        rows.append((i, text, "en", "s", 0))
        labels.append((i, int(not bad), int(toxic)))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels + [(None, 1, 1), (5, None, None)], LABELS)


def test_classifiers_on_held_out_rows(docs, rows, labelled, empty):
    texts, labels = labelled
    for found, label in ((quality.score_quality(texts, labels), "quality"), (toxicity.score_toxicity(texts, labels), "toxic")):
        held = found.join(labels, "doc_id").where(f"held_out and {label} is not null").collect()
        assert len(held) > 40 and sum(r.predicted == r[label] for r in held) >= 0.95 * len(held)
    for f in (quality.score_quality, toxicity.score_toxicity):
        odd = f(docs, labels).collect()
        assert len(odd) == len(rows) and all(0 <= r.score <= 1 for r in odd)
        assert f(docs, labels.limit(0)).count() == len(rows) and f(empty, labels).count() == 0
    assert toxicity.remove_toxic(docs, labels).columns == docs.columns


def test_toxicity_knows_copies_and_fixed_phrases(spark):
    r = random.Random(6)
    rows, labels = [], []
    for i in range(300):
        toxic = i % 6 == 0
        text = prose(r, 60).replace(".", "")
        if toxic and i >= 60:  # a phrase that opens every text: only its last word has several neighbours
            text = "vile brute " + text
        rows.append((i, text, "en", "s", 0))
        labels.append((i, 0, int(toxic)))
    texts = {row[0]: row[1] for row in rows}
    rows += [(1000 + i, texts[i], "en", "s", 0) for i in range(0, 60, 6)]  # copies without the phrase
    rows += [(2000 + i, "vile brute " + prose(r, 60), "en", "s", 0) for i in range(10)]
    rows += [(3000 + i, prose(r, 60), "en", "s", 0) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    out = toxicity.score_toxicity(docs, spark.createDataFrame(labels, LABELS), folds=5, held=9).collect()
    got = {x.doc_id: x for x in out}
    assert all(got[1000 + i].predicted == 1 and i in got[1000 + i].evidence_ids for i in range(0, 60, 6))
    assert all(got[2000 + i].predicted == 1 for i in range(10))
    assert sum(got[3000 + i].predicted for i in range(40)) <= 2 and all(got[3000 + i].evidence_ids for i in range(40))


def test_nearest_of_a_batch_is_exact():
    import numpy as np

    g = np.random.default_rng(1)
    x = toxicity.weigh(g.poisson(0.1, (3000, 60)).astype(np.float32), np.ones(60, np.float32))
    x = x[x.any(axis=1)]
    _, cosine = toxicity.BlockMaxIndex(x).nearest_each(x[::50], 10)
    assert np.allclose(cosine, -np.sort(-(x[::50] @ x.T), axis=1)[:, :10], atol=1e-5)


def test_block_max_index_is_exact():
    import numpy as np

    g = np.random.default_rng(0)
    x = toxicity.weigh(g.poisson(0.05, (700, 40)).astype(np.float32), np.ones(40, np.float32))
    x = x[x.any(axis=1)]
    index = toxicity.BlockMaxIndex(x)
    for q in x[::20]:
        _, cosine = index.nearest(q, 10)
        assert np.allclose(cosine, np.sort(x @ q)[::-1][:10], atol=1e-5)


def test_models_travel_without_this_package(spark, labelled):
    import pickle

    from codespan.llm.labelled import labelled_sample

    texts, labels = labelled
    sample = labelled_sample(texts, labels, "toxic", 50, F.lit(True))
    assert b"codespan" not in pickle.dumps(toxicity.fit(texts, sample))


def test_samples_do_not_depend_on_the_order_of_rows(spark):
    from codespan.llm.labelled import labelled_sample

    rows = [(i % 20, f"text {i}", "en", "s", 0) for i in range(100)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], LABELS)
    taken = [
        sorted(map(tuple, labelled_sample(spark.createDataFrame(own, DOCS).repartition(n), labels, "quality", 30, F.lit(True)).collect()))
        for own, n in ((rows, 1), (rows[::-1], 7))
    ]
    assert taken[0] == taken[1] and len(taken[0]) == 20
