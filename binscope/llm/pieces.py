"""SentencePiece encoding and decoding (operator 2) for merge-type vocabularies.

Encoding: a text's blanks become U+2581 and one is put in front. All adjacent
symbol pairs whose concatenation is a piece go on an agenda ordered by piece
score (leftmost first among equals); the best one is merged, its new neighbour
pairs are put on the agenda, and entries whose symbols have changed meanwhile
are skipped. Of a short text the agenda is the list of its pairs' scores in text order, of which
the first best one is taken. What is no piece falls back to its UTF-8 byte pieces.

A merge never crosses a boundary between two characters that stand side by side
in no piece. Texts are cut there into chunks, which are encoded once and kept in
a bounded cache per worker; the result is the same as for the whole text. Every
chunk that enters the cache is checked against the sentencepiece library, all
new chunks of an Arrow batch in one call.

Defined results: null is an empty text and has no ids; any other text, white
space, NUL, U+2581 or unknown characters included, gives what the library gives.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.llm.text import cache_of, giving_back, text_column

BLANK = "▁"
#: Chunks, and parts of them, that a worker keeps; later ones are kept for one slice of texts.
CACHE_CHUNKS = 300_000
#: Up to so many characters the agenda is a list; a list's work grows with the square of the length.
SHORT = 48
_NEVER = float("inf")


class Vocabulary:
    """Pieces and scores of a merge-type model that keeps white space and adds a leading blank."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        sp = self.library
        n = sp.vocab_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        if any(sp.is_unused(i) for i in range(n)):
            raise ValueError("vocabularies with unused pieces are not covered")
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.rank = {p: (-sp.get_score(i), i) for p, i in self.ids.items()}
        self.cost = {p: r[0] for p, r in self.rank.items()}
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        if len(self.byte_ids) != 256:
            raise ValueError("the vocabulary has no byte pieces to fall back to")
        if sp.encode("  a  ", out_type=str) != sp.encode("  a  ") and sp.decode(sp.encode("  a  ")) != "  a  ":
            raise ValueError("the model does not keep white space as it is")
        self.unknown = sp.unk_id()
        self.bytes_of = [b"" if sp.is_control(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(self.pieces)]
        for b, i in self.byte_ids.items():
            self.bytes_of[i] = bytes([b])
        self.is_bytes = frozenset(self.byte_ids.values())
        self.joined = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.chunk_ids: dict[str, str] = {}  # ids as text, joined by commas
        self.part_ids: dict[str, tuple[int, ...]] = {}
        self.odd: dict[str, str] = {}  # chunks that decode to something else than themselves
        #: Cutting before a blank that follows another character, and around line ends, is always safe here.
        self.line_cut = not any("\n" in p and len(p) > 1 for p in self.ids)
        self.blank_cut = not any(BLANK in p.lstrip(BLANK) for p in self.ids)

    def merge(self, symbols: str) -> list[int]:
        """Ids of a text whose blanks are replaced, by the agenda of adjacent pairs."""
        if len(symbols) <= SHORT:
            return self.ids_of(self.merge_short(symbols))
        rank, n = self.rank, len(symbols)
        part = list(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, int, str]] = []
        for i in range(n - 1):
            found = rank.get(pair := symbols[i:i + 2])
            if found:
                agenda.append((found[0], i, i + 1, pair))
        heapq.heapify(agenda)
        while agenda:
            _, i, j, pair = heapq.heappop(agenda)
            if not part[i] or after[i] != j or part[i] + part[j] != pair:
                continue  # one of the two has been merged meanwhile
            part[i], part[j] = pair, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := rank.get(new := pair + part[k]):
                    heapq.heappush(agenda, (found[0], i, k, new))
            h = before[i]
            if h >= 0 and (found := rank.get(new := part[h] + pair)):
                heapq.heappush(agenda, (found[0], h, i, new))
        return self.ids_of([p for p in part if p])

    def merge_short(self, symbols: str) -> list[str]:
        """Pieces of a text: ``agenda[i]`` is the score of merging parts i and i + 1, and the leftmost best is next."""
        cost, part = self.cost.get, list(symbols)
        agenda = [cost(a + b, _NEVER) for a, b in zip(part, symbols[1:])]
        while agenda and (best := min(agenda)) < _NEVER:
            i = agenda.index(best)
            del agenda[i]
            pair = part[i] = part[i] + part.pop(i + 1)
            if i < len(agenda):
                agenda[i] = cost(pair + part[i + 1], _NEVER)
            if i:
                agenda[i - 1] = cost(part[i - 1] + pair, _NEVER)
        return part

    def ids_of(self, parts: list[str]) -> list[int]:
        ids = self.ids
        try:
            return [ids[p] for p in parts]
        except KeyError:
            return [i for p in parts for i in ((ids[p],) if p in ids else [self.byte_ids[b] for b in p.encode()])]

    def cut(self, chunk: str) -> list[str]:
        """Parts of a chunk between characters that stand side by side in no piece."""
        joined = self.joined
        ends = [k for k, (a, b) in enumerate(zip(chunk, chunk[1:]), 1) if a + b not in joined]
        if not ends:
            return [chunk]
        return [chunk[a:b] for a, b in zip([0, *ends], [*ends, len(chunk)])]

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces side by side, byte pieces as UTF-8, blanks as spaces, without the leading one."""
        text = self.decode_bytes(ids).decode("utf-8", errors="replace")
        return text[1:] if text.startswith(" ") else text

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        return [i for chunk in self.chunks(text) for part in self.cut(chunk) for i in self.merge(part)]

    def chunks(self, text: str) -> list[str]:
        s = BLANK + text.replace(" ", BLANK)
        if not self.blank_cut:
            return [s]
        if BLANK * 2 not in s:
            s = s.replace(BLANK, " " + BLANK)
            if self.line_cut:
                s = s.replace("\n", " \n ")
            return [x for x in s.split(" ") if x]
        pattern = f"\n|{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+" if self.line_cut else f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+"
        return re.findall(pattern, s)

    def learn(self, new: set[str]) -> None:
        """Put new chunks into the cache, checked against the library."""
        known, merge = self.part_ids, self.merge
        own = {}
        for c in new:
            ids: list[int] = []
            for part in self.cut(c):
                got = known.get(part)
                if got is None:
                    got = known[part] = tuple(merge(part))
                ids += got
            own[c] = ids
        # The library puts a blank in front of every text, so the others are checked behind one.
        for right, c in zip(self.library.encode([c[1:] if c[0] == BLANK else c for c in own], num_threads=1), own):
            ids = own[c] if c[0] == BLANK else self.merged(BLANK + c)
            if len(c) > 1 and ids != right:
                raise AssertionError(f"encoding of {c!r} differs from the library: {ids} and {right}")
        for c, ids in own.items():
            self.chunk_ids[c] = ",".join(map(str, ids))
            if self.is_bytes.isdisjoint(ids):
                continue  # pieces side by side are the chunk
            plain = self.decode_bytes(ids).decode("utf-8", errors="replace")
            if plain != c.replace(BLANK, " "):
                self.odd[c] = plain

    def merged(self, chunk: str) -> list[int]:
        return [i for part in self.cut(chunk) for i in self.merge(part)]


_VOCABULARY: dict[str, Vocabulary] = cache_of("pieces")


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARY:
        _VOCABULARY[path] = Vocabulary(path)
    return _VOCABULARY[path]


def _scan(path: str, text: str, names: list[str], own: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            cols = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            column = text_column(cols[text])
            rows: list[list] = [[], [], []]
            at = 0
            while at < len(column):
                end, size = at, 0
                while end < len(column) and size < 1 << 20:
                    size += len(column[end].as_py())
                    end += 1
                _encode(v, column.slice(at, end - at).to_pylist(), rows)
                at = end
            for k, r, kind in zip(own, rows, (pa.int64(), pa.string(), pa.string())):
                cols[k] = pa.array(r, type=kind)
            yield pa.RecordBatch.from_arrays([cols[k] for k in names], names=names)

    return run


def _encode(v: Vocabulary, texts: list[str], rows: list[list]) -> None:
    chunked = [v.chunks(t) if t else [] for t in texts]
    known = v.chunk_ids
    new = {c for c in set().union(*chunked) if c not in known}
    if new:
        v.learn(new)
    ids_of = known.__getitem__
    for text, chunks in zip(texts, chunked):
        ids = ",".join(map(ids_of, chunks))
        if v.odd:
            plain = "".join([v.odd.get(c) or c.replace(BLANK, " ") for c in chunks])
            plain = plain[1:] if plain[:1] == " " else plain
        else:  # every chunk decodes to itself, so the text does, but for its own U+2581
            plain = (text or "").replace(BLANK, " ")
        rows[0].append(ids.count(",") + 1 if ids else 0)
        rows[1].append(hashlib.sha256(ids.encode()).hexdigest())
        rows[2].append(hashlib.sha256(plain.encode()).hexdigest())
    if len(known) > CACHE_CHUNKS:
        for c in new:
            del known[c]
            v.odd.pop(c, None)
    while len(v.part_ids) > CACHE_CHUNKS:
        v.part_ids.popitem()  # the latest first: frequent parts come early


def encode_documents(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all, if None) and struct ``_pieces``: number of ids, digest of the
    ids and digest of the decoded text."""
    kept = docs.columns if keep is None else keep
    own = ["__pieces_n", "__pieces_ids", "__pieces_text"]
    shown = docs.select(*[F.col(f"`{c}`") for c in kept], *[F.lit(None).cast(t).alias(k) for k, t in zip(own, ("long", "string", "string"))]).schema
    out = docs.mapInArrow(giving_back(_scan(path, text, shown.names, own), keeps="pieces"), shown)
    return out.select(*[F.col(f"`{c}`") for c in kept], F.struct(
        *[F.col(k).alias(c) for k, c in zip(own, ("n_tokens", "ids_sha256", "decoded_sha256"))]).alias("_pieces"))


def encode_ids(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``token_ids``, the ids themselves."""
    shown = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "token_ids"], F.lit(None).cast("array<int>").alias("token_ids")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            cols = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            cols["token_ids"] = pa.array([v.encode(t) for t in text_column(cols[text]).to_pylist()], type=pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([cols[k] for k in shown.names], names=shown.names)

    return docs.mapInArrow(giving_back(run, keeps="pieces"), shown)
