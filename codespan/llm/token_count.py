"""Token counts of whole texts for a piece model, most words by a proven shortcut.

``prove`` finds out offline which vocabulary strings the library encodes alone as
one token.  A text is cut where no piece of the vocabulary can reach across:
before a run of spaces, and around characters that no piece holds.  Cuts that are
proven whole tokens count 1; only the rest is encoded, each distinct one once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codespan.llm.hashing import slices

SPACE = "▁"
REMEMBERED = 1 << 20  # distinct cuts whose count a task keeps
SLICE = 1 << 20  # bytes of text cut up at a time
LIMIT = 4096


def _processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def _pieces(processor) -> list[str]:
    return [
        processor.id_to_piece(i)
        for i in range(processor.get_piece_size())
        if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i))
    ]


def cuttable(processor) -> bool:
    """Whether texts may be cut before spaces and around line ends.

    True if spaces stand only at the front of pieces (or make up whole pieces), no
    piece holds a line end, and the model changes no text but its spaces.
    """
    plain = all(SPACE not in p.lstrip(SPACE) and "\n" not in p for p in _pieces(processor))
    sample = "Aa  b\tc ÉＡ½\n\n x​́ "
    return (
        plain
        and processor.encode("\n", out_type=str) == [SPACE, "<0x0A>"]
        and processor.decode(processor.encode(sample)) == sample
    )


def prove(model: bytes) -> frozenset[str]:
    """Vocabulary strings, with spaces as such, that alone are one token.

    Strings without a space in front are encoded after a line end, which nothing
    merges with; it and the space the library puts before a text are two tokens.
    """
    processor = _processor(model)
    proven = []
    for piece in _pieces(processor):
        text = piece.replace(SPACE, " ")
        if piece.startswith(SPACE):
            if processor.encode(text[1:], out_type=str) == [piece] and text.strip(" "):
                proven.append(text)
        elif processor.encode("\n" + text, out_type=str)[2:] == [piece]:
            proven.append(text)
    return frozenset(proven)


class Counter:
    """Tokens of cuts, each distinct cut encoded once while it is remembered."""

    def __init__(self, model: bytes, proven: frozenset[str]):
        self.processor, self.proven = _processor(model), proven
        self.known = {"\n": 1}

    def learn(self, cuts: set[str]) -> None:
        """Count the cuts not known yet: proven ones directly, the others by merging.

        What the library puts before a text is a space, which the cuts that begin
        with one have already.  The others go behind a line end, and spaces alone
        before one, as that is how they stand in their text.
        """
        new = cuts - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {"\n": 1}
            new = cuts - self.known.keys()
        whole = new & self.proven
        self.known.update(dict.fromkeys(whole, 1))
        rest = list(new - whole)
        alone = [not c.strip(" ") for c in rest]
        padded = [
            c[1:] + "\n" if bare else c[1:] if c[0] == " " else "\n" + c
            for c, bare in zip(rest, alone)
        ]
        for c, bare, tokens in zip(rest, alone, self.processor.encode(padded, num_threads=1)):
            self.known[c] = len(tokens) - (1 if bare else 0 if c[0] == " " else 2)

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text; the piece mark itself is read as the space it stands for."""
        totals, waiting = [], {}
        find, of = CUTS.findall, self.known.get
        for i, text in enumerate(texts):
            cuts = find(" " + text.replace(SPACE, " ")) if text else []
            counts = list(map(of, cuts))
            if None in counts:
                waiting[i] = cuts
                totals.append(0)
            else:
                totals.append(sum(counts))
        if waiting:
            self.learn(set(chain.from_iterable(waiting.values())))
            for i, cuts in waiting.items():
                totals[i] = sum(map(self.known.__getitem__, cuts))
        return totals


CUTS = re.compile(r"\n| *[^ \n]+| +")


def _count(model, proven, cut_up: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(model.value, proven.value)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                texts = part.column("text").to_pylist()
                if cut_up:
                    n = counter.count(texts)
                else:
                    n = [len(t) for t in counter.processor.encode(texts, num_threads=1)]
                yield pa.record_batch(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(n, pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    return run


def token_counts(docs: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs`` (doc_id, text).

    Null texts count as empty: 0 bytes, 0 tokens.  Special strings in a text are
    ordinary text.  The model file is read once, on the driver, and sent along
    with the proven strings; both are bounded by the vocabulary.  Columns besides
    doc_id and text are ignored; rows that repeat are all returned.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    context = docs.sparkSession.sparkContext
    cut_up = cuttable(_processor(model))
    run = _count(context.broadcast(model), context.broadcast(prove(model) if cut_up else frozenset()), cut_up)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        text.alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
