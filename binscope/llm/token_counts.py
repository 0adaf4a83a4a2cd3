"""Token counts by overlap resynchronisation (operator 13).

Texts of up to ``chunk`` code points are counted whole, in slices of about 1 MB. A longer one is cut into cores of
``chunk`` code points; each core has a row, and so a task, of its own, with ``overlap`` code points on both sides.
Around the border of two cores both chunks are encoded with the offsets of their tokens and give the nearest marks: places that are *stable* and at which a token ends and the next begins, with the ids of the two tokens.
Chunks are spliced at the first mark that both have. Where none is common, the overlap of that
text is widened fourfold (and the chunk with it), until its chunks align or it is a chunk itself.

A place is stable if no token can reach across it, whatever stands before and behind: beside ASCII white
space, which the pre-tokeniser's pattern never matches; between ASCII characters of different class
(letter, digit, other) and beside an ASCII digit, where every match of the pattern ends. Not behind an
apostrophe, as its contractions depend on what is before it. An ASCII character composes with nothing before it,
so normalising does not reach across either. For the same reason the library is asked once for each distinct
piece between white space; a worker remembers its count. A special string has such places inside, but the zone of the
marks is longer than any, so one of the two chunks has it whole, and no mark in it.

So the count is that of the whole text: the tokens of the last chunk, and at each border what the left chunk
has before the mark minus what the right chunk has before it.

Defined results: null is an empty text and has no tokens; rows are treated by themselves, repeated rows and null
ids included; strings of special tokens in a text are one token each, as the library's default has it; columns
that are kept pass through, whatever their names.
"""

from __future__ import annotations

import bisect
import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.llm.text import SLICE_BYTES, text_column
from binscope.session import cut_lineage

CHUNK, OVERLAP = 1 << 14, 1 << 8
#: Marks that a chunk gives for a border, the nearest ones.
MARKS = 16
#: Pieces whose counts a worker keeps.
MEMO = 600_000
#: How much wider the next overlap, and longer the next chunk, is.
WIDER = 4
_BLANK = re.compile(r"[ \t\n\x0b\x0c\r]")
_SPACE, _OTHER = r" \t\n\x0b\x0c\r", r"!-/:-@\[-`{-~"
_STABLE = re.compile(
    rf"(?<=[{_SPACE}])(?=.)|(?<=.)(?=[{_SPACE}])"
    rf"|(?<=[0-9])(?=[!-~])|(?<=[A-Za-z])(?=[0-9{_OTHER}])"
    rf"|(?<=[{_OTHER}])(?<!')(?=[0-9A-Za-z])", re.DOTALL)


class Encoder:
    """The library's tokenizer of a file, for vocabularies that drop white space, and token counts of pieces
    between white space, and of parts of them between stable places, that it has given."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        self.special = [a.content for a in t.get_added_tokens_decoder().values()]
        if any(re.search(rf"[{_SPACE}]", x) for x in self.special):
            raise ValueError("special strings with white space are not covered")
        for probe in ("a b", " a  b ", "it's 12\nb2b, (c)-d e.", "x\t'\u0301s y"):
            parts = [i for part in probe.split() for i in self.ids(part)]
            if self.ids(probe) != parts or parts != [i for part in _STABLE.split(probe) for i in self.ids(part)]:
                raise ValueError("tokens of this vocabulary reach across white space or classes of characters")
        self.known: dict[bytes, int] = {}

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _learn(self, pieces: list[bytes]) -> None:
        """Counts of new pieces, all in one call of the library."""
        parts = [[x] if any(a in x for a in self.special) else _STABLE.split(x) for x in (p.decode() for p in pieces)]
        known = self.known
        new = [x for x in {x for own in parts for x in own} if x.encode() not in known]
        counts = {x: len(e) for x, e in zip(new, self.library.encode_batch_fast(new, add_special_tokens=False))}
        for piece, own in zip(pieces, parts):
            known[piece] = sum([counts[x] if x in counts else known[x.encode()] for x in own])
        known.update((x.encode(), n) for x, n in counts.items())

    def count(self, texts: list[str]) -> list[int]:
        """Number of tokens of each text."""
        split = [t.encode().split() for t in texts]  # by the six ASCII white-space characters
        known = self.known
        new = [p for p in set().union(*split) if p not in known]
        before = len(known)
        if new:
            self._learn(new)
        out = [sum(map(known.__getitem__, words)) for words in split]
        for _ in range(max(0, len(known) - max(before, MEMO))):
            known.popitem()  # the latest first: frequent pieces come early
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _spaced(text: str, lo: int, hi: int) -> tuple[int, int]:
    """The least range around [lo, hi) that begins and ends at white space or at an end of the text."""
    before = max(text.rfind(c, 0, lo) for c in " \t\n\x0b\x0c\r")
    behind = _BLANK.search(text, hi)
    return before + 1, behind.start() if behind else len(text)


def marks(e: Encoder, text: str, border: int, reach: int) -> list[dict]:
    """The ``MARKS`` stable places nearest to ``border``, less than ``reach`` away, where a token ends and another
    begins: place, tokens of the text before it, ids of the tokens beside it."""
    lo, hi = max(0, border - reach), min(len(text), border + reach)
    begin, end = _spaced(text, lo, hi)
    found = e.library.encode(text[begin:end], add_special_tokens=False)
    ids, starts, ends = found.ids, [begin + a for a, _ in found.offsets], [begin + b for _, b in found.offsets]
    earlier = e.count([text[:begin]])[0]
    out = []
    places = (m.start() for m in _STABLE.finditer(text, max(0, lo - 1), min(len(text), hi + 1)))
    for _, x in sorted((abs(x - border), x) for x in places if lo < x < hi):
        n = bisect.bisect_left(starts, x)
        if 0 < n < len(ids) and ends[n - 1] <= x:
            out.append({"place": x, "n": earlier + n, "before": ids[n - 1], "behind": ids[n]})
            if len(out) == MARKS:
                break
    return out


def _first(path: str, text: str, names: list[str], chunk: int):
    """Adds bytes, tokens of texts of up to ``chunk`` code points, and a key and the text of longer ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            cols = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            column = text_column(cols[text])
            at = 0
            while at < len(column):
                end, size = at, 0
                while end < len(column) and size < SLICE_BYTES:
                    size += len(column[end].as_py())
                    end += 1
                part = column.slice(at, end - at)
                texts = part.to_pylist()
                short = [len(x) <= chunk for x in texts]
                counts = iter(e.count([x for x, s in zip(texts, short) if s]))
                own = {k: c.slice(at, end - at) for k, c in cols.items()}
                own["__n_bytes"] = pc.binary_length(part).cast(pa.int64())
                own["__n_tokens"] = pa.array([next(counts) if s else None for s in short], pa.int64())
                own["__key"] = pa.array([None if s else uuid.uuid4().hex for s in short], pa.string())
                own["__long"] = pa.array([None if s else x for x, s in zip(texts, short)], pa.string())
                yield pa.RecordBatch.from_arrays([own[k] for k in names], names=names)
                at = end
    return run


def _cut(chunk: int, overlap: int):
    """Overlapping chunks of long texts: (key, seq, last, from, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                cores = -(-len(text) // chunk)
                for lo in range(0, cores, 64):
                    seqs = range(lo, min(cores, lo + 64))
                    begins = [max(0, k * chunk - overlap) for k in seqs]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([key] * len(seqs)), pa.array(list(seqs), pa.int64()), pa.array([k == cores - 1 for k in seqs]), pa.array(begins, pa.int64()),
                        pa.array([text[b:(k + 1) * chunk + overlap] for b, k in zip(begins, seqs)])], names=["key", "seq", "last", "begin", "text"])
    return run


_MARK = "array<struct<place:bigint,n:bigint,before:bigint,behind:bigint>>"
_ENDS = f"key string, border long, on_left boolean, marks {_MARK}, n long"


def _encode(path: str, chunk: int, overlap: int):
    """For each chunk its marks at both borders, and its number of tokens where it is the last."""
    kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("place", "n", "before", "behind")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            rows: list[tuple] = []
            for key, seq, last, begin, text in zip(*[c.to_pylist() for c in batch.columns[:4]], batch.column(4)):
                text = text.as_py()
                for border, on_left in ((seq, False), (seq + 1, True)):
                    if border == 0 or (on_left and last):
                        continue
                    own = marks(e, text, border * chunk - begin, overlap)
                    rows.append((key, border, on_left, [m | {"place": m["place"] + begin} for m in own], None))
                if last:
                    rows.append((key, None, None, None, e.count([text])[0]))
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.bool_(), kind, pa.int64()))],
                                             names=["key", "border", "on_left", "marks", "n"])
    return run


def _splice(ends: DataFrame) -> DataFrame:
    """(key, aligned, n_tokens): both sides of each border meet at their nearest common mark."""
    def side(left: bool):
        return F.max(F.when(F.col("on_left") == left, F.col("marks")))

    borders = ends.filter(F.col("border").isNotNull()).groupBy("key", "border").agg(side(True).alias("a"), side(False).alias("b"))
    same = F.filter("a", lambda x: F.exists("b", lambda y: (y["place"] == x["place"]) & (y["before"] == x["before"]) & (y["behind"] == x["behind"])))
    met = borders.withColumn("at", F.get(same, F.lit(0)))
    right = F.get(F.filter("b", lambda y: y["place"] == F.col("at.place")), F.lit(0))
    parts = met.select("key", F.col("at").isNotNull().alias("aligned"), (F.col("at.n") - right["n"]).alias("n"))
    last = ends.filter(F.col("border").isNull()).select("key", F.lit(True).alias("aligned"), "n")
    return parts.union(last).groupBy("key").agg(F.bool_and("aligned").alias("aligned"), F.sum("n").alias("n_tokens"))


def count_long(long_texts: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, n_tokens) of long texts (key, text; keys distinct), spliced from chunks that different tasks encode."""
    done = None
    while True:
        chunks = long_texts.select("key", "text").mapInArrow(_cut(chunk, overlap), "key string, seq long, last boolean, begin long, text string")
        ends = chunks.repartition("key", "seq").mapInArrow(_encode(path, chunk, overlap), _ENDS)
        found = cut_lineage(_splice(cut_lineage(ends, "ends")), "spliced")
        good = found.filter("aligned").select("key", "n_tokens")
        done = good if done is None else done.union(good)
        failed = found.filter("not aligned").select("key")
        if not failed.limit(1).count():
            return done
        long_texts = long_texts.join(failed, "key", "left_semi")
        chunk, overlap = chunk * WIDER, overlap * WIDER


def count_tokens(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all, if None) and struct ``_tokens``: ``n_bytes`` and ``n_tokens``."""
    kept = docs.columns if keep is None else keep
    own = {"__n_bytes": "long", "__n_tokens": "long", "__key": "string", "__long": "string"}
    plain = [f"__c{i}" for i in range(len(kept))]  # names that parquet and joins take
    rows = docs.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(kept, plain)], F.col(f"`{text}`").cast("string").alias("__text"))
    shown = rows.select(*plain, *[F.lit(None).cast(t).alias(c) for c, t in own.items()]).schema
    # the keys are drawn at random, so they are written before anything is done with them
    first = cut_lineage(rows.mapInArrow(_first(path, "__text", shown.names, chunk), shown), "counted")
    longer = first.filter(F.col("__key").isNotNull()).select(F.col("__key").alias("key"), F.col("__long").alias("text"))
    found = count_long(longer, path, chunk, overlap).select(F.col("key").alias("__key"), F.col("n_tokens").alias("__spliced"))
    whole = first.select(*plain, "__n_bytes", "__n_tokens", "__key")
    short = whole.filter(F.col("__key").isNull()).drop("__key")
    spliced = whole.filter(F.col("__key").isNotNull()).join(found, "__key").select(*plain, "__n_bytes", F.col("__spliced").alias("__n_tokens"))
    return short.union(spliced).select(*[F.col(p).alias(c) for p, c in zip(plain, kept)], F.struct(
        F.col("__n_bytes").alias("n_bytes"), F.col("__n_tokens").alias("n_tokens")).alias("_tokens"))
