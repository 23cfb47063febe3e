"""Encoding with a merge-type piece vocabulary, exactly and in one pass, and decoding.

A sequence of pieces is what merging gives if every piece merges to itself and every two
neighbours merge to these two again. So pieces are laid from left to right, the longest that fits
first (all matches come from an Aho-Corasick automaton); a piece that is not compatible with its
left neighbour gives way to the next shorter one, and where none is left the place is marked as
failed in a bitfield and the piece before is taken back. Each place fails once, so the work is
linear in the text, whatever it holds.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import groupby, takewhile
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import by_value
from starmart.llm.tokens import slices

by_value(__name__)

BLANK = "▁"
UNKNOWN, BEGIN, END = "<unk>", "<s>", "</s>"
UNKNOWN_TEXT = " ⁇ "
# Bounds of memory, not of work: what does not fit is computed again.
KEPT_SEGMENTS, KEPT_LENGTH, KEPT_PAIRS = 1 << 17, 64, 1 << 20
DECODE_IDS = WHOLE_TEXT = 1 << 20
# Places where texts may be cut, the finest first: between letters and signs, at blanks, nowhere.
LETTERS = "A-Za-z\u00c0-\u1fff\u2c00-\U0010ffff"
CUTS = (
    rf"\n|{BLANK}*[{LETTERS}]+|{BLANK}*[^{LETTERS}{BLANK}\n]+|{BLANK}+",
    rf"\n|{BLANK}*[^{BLANK}\n]+|{BLANK}+",
    r"(?s:.+)",
)


class Vocabulary(NamedTuple):
    """texts: of each id, None if no text can match it; ranks: order of merging, ties are equal.

    bytes: the id of each byte; surfaces: what an id decodes to. cut: a pattern of the segments
    that no piece reaches over. shorter: of each id the longest piece that begins it, or -1. edges:
    of each id the lives of the symbols at its left and right end while it is merged, or None
    where these are not in the order of the ranks.
    """

    texts: list
    ranks: list
    bytes: list
    surfaces: list
    begin: int
    end: int
    cut: str
    shorter: list
    edges: list


def merged(symbols: list[str], ids: dict[str, int], ranks: list) -> list[str]:
    """Merge neighbours whose text is a piece, the best rank first and ties from the left."""
    symbols = list(symbols)
    while True:
        best, at = None, -1
        for i in range(len(symbols) - 1):
            found = ids.get(symbols[i] + symbols[i + 1])
            if found is not None and (best is None or ranks[found] < best):
                best, at = ranks[found], i
        if at < 0:
            return symbols
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]


NEVER = 1 << 60


def edge_lives(text: str, ids: dict[str, int], ranks: list) -> tuple | None:
    """(symbol, rank it is made at, rank it is merged away at) at the left and at the right end.

    None if some rank comes twice or out of order, where ranks cannot stand for time.
    """
    symbols, lives, now = list(text), ([[text[0], -1]], [[text[-1], -1]]), -1
    while len(symbols) > 1:
        rank, at = min(
            (ranks[ids[a + b]], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in ids
        )
        if rank <= now and now >= 0:
            return None
        now = rank
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        for side, live in zip((0, -1), lives):
            if symbols[side] != live[-1][0]:
                live[-1].append(now)
                live.append([symbols[side], now])
    return tuple(tuple((s, *made, *([NEVER] if len(made) == 1 else ())) for s, *made in live) for live in lives)


def read_vocabulary(path: str) -> Vocabulary:
    """Pieces and scores of a model file with byte fallback, read once on the driver.

    Pieces that merging never makes are left out. Raises ValueError for a model whose texts are
    normalised or whose pieces hold characters that are no pieces: these need other rules.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) for i in range(n)]
    texts = [model.id_to_piece(i) if plain[i] else None for i in range(n)]
    ids = {t: i for i, t in enumerate(texts) if t is not None}
    if set("".join(ids)) - set(ids):
        raise ValueError("a piece holds a character that is not a piece")
    probe = "é ﬁ  ①Ａ"
    if "".join(model.encode(probe, out_type=str)) != "".join(model.encode(BLANK.join(probe.split(" ")), out_type=str)) \
            or model.decode(model.encode(probe)) != probe:
        raise ValueError("the model normalises texts")
    order = {s: r for r, s in enumerate(sorted({-model.get_score(i) for i in ids.values()}))}
    ranks = [order.get(-model.get_score(i), -1) for i in range(n)]
    made = [t if t is not None and merged(list(t), ids, ranks) == [t] else None for t in texts]
    kept = {t: i for i, t in enumerate(made) if t is not None}
    shorter = [
        -1 if t is None else next((kept[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in kept), -1)
        for t in made
    ]
    raw = [-1] * 256
    surfaces = []
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            raw[int(piece[3:-1], 16)] = i
            surfaces.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(i):
            surfaces.append(b"")
        else:
            known = UNKNOWN_TEXT if model.is_unknown(i) else piece.replace(BLANK, " ")
            surfaces.append(known.encode())
    if min(raw) < 0:
        raise ValueError("the model has no byte fallback")
    cut = next(c for c in CUTS if all(re.findall(c, t) == [t] for t in ids))
    edges = [None if t is None else edge_lives(t, ids, ranks) for t in made]
    return Vocabulary(made, ranks, raw, surfaces, model.bos_id(), model.eos_id(), cut, shorter, edges)


class Segments(dict):
    """The ids of segments, packed as little-endian unsigned 32-bit integers.

    When it is full, the segments used since then push out the others.
    """

    def __init__(self, encoder: Encoder):
        self.encoder, self.before = encoder, {}

    def __missing__(self, segment: str) -> bytes:
        packed = self.before.get(segment)
        if packed is None:
            packed = array("I", self.encoder.segment(segment)).tobytes()
        if len(segment) <= KEPT_LENGTH:
            if len(self) >= KEPT_SEGMENTS:
                self.before = dict(self)
                self.clear()
            self[segment] = packed
        return packed


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.vocabulary = vocabulary
        self.ids = {t: i for i, t in enumerate(vocabulary.texts) if t is not None}
        self.sizes = [0 if t is None else len(t) for t in vocabulary.texts]
        self.automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.cut = re.compile(vocabulary.cut)
        self.segments = Segments(self)
        self.pieces = [t or "" for t in vocabulary.texts]
        self.raw = frozenset(vocabulary.bytes)
        self.controls = frozenset(i for i, s in enumerate(vocabulary.surfaces) if not s)
        # A mark that is no UTF-8 leads decode() to its runs if a control id stands inside a text.
        self.surfaces = [s or b"\xff" for s in vocabulary.surfaces]
        self.edges = tuple(array("I", [i]).tobytes() for i in (vocabulary.begin, vocabulary.end))

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the text of the two pieces gives these two again."""
        key = left * len(self.sizes) + right
        found = self.pairs.get(key)
        if found is None:
            one, two = self.vocabulary.edges[left], self.vocabulary.edges[right]
            if one and two:
                found = self._apart(one[1], two[0])
            else:
                a, b = self.vocabulary.texts[left], self.vocabulary.texts[right]
                found = merged([*a, *b], self.ids, self.vocabulary.ranks) == [a, b]
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            self.pairs[key] = found
        return found

    def _apart(self, ends: tuple, starts: tuple) -> bool:
        """Merge both sides again in step: no symbols that meet at the seam are merged across it.

        A merge of equal rank comes first if it is further left.
        """
        ids, ranks, i, j = self.ids, self.vocabulary.ranks, 0, 0
        while True:
            left, made, gone = ends[i]
            right, made_right, gone_right = starts[j]
            across = ids.get(left + right)
            if across is not None:
                when = max(ranks[across], made, made_right)
                if when < gone and when <= gone_right:
                    return False
            if gone == gone_right == NEVER:
                return True
            if gone <= gone_right:
                i += 1
            else:
                j += 1

    def segment(self, text: str) -> list | array:
        """The ids of a text without blanks put before it."""
        found = self.ids.get(text)
        if found is not None:
            return [found]
        tiles = [piece for _, piece in self.automaton.iter_long(text)]
        if self._sound(tiles, len(text)):
            return tiles
        sizes = self.sizes
        longest = [-1] * len(text) if len(text) <= KEPT_LENGTH else array("i", [-1]) * len(text)
        for end, piece in self.automaton.iter(text):
            longest[end - sizes[piece] + 1] = piece
        out, at = array("I"), 0
        while at < len(text):
            try:
                stop = longest.index(-1, at)
            except ValueError:
                stop = len(text)
            if stop > at:
                self._lay(longest, at, stop, out)
            if stop < len(text):  # a character in no piece stands alone, as its bytes
                out.extend(self.vocabulary.bytes[b] for b in text[stop].encode())
            at = stop + 1
        return out

    def _sound(self, tiles: list, size: int) -> bool:
        """Whether the longest matches, each after the other, already are what merging gives."""
        pairs, width, left = self.pairs, len(self.sizes), -1
        for piece in tiles:
            size -= self.sizes[piece]
            if left >= 0:
                known = pairs.get(left * width + piece)
                if known is None:
                    known = self.compatible(left, piece)
                if not known:
                    return False
            left = piece
        return size == 0

    def _lay(self, longest: list | array, start: int, stop: int, out: array) -> None:
        sizes, shorter, pairs, width = self.sizes, self.vocabulary.shorter, self.pairs, len(self.sizes)
        failed = bytearray((stop - start >> 3) + 1)
        base, at, piece = len(out), start, longest[start]
        while True:
            end = at + sizes[piece]
            place = end - start
            fits = not failed[place >> 3] >> (place & 7) & 1
            if fits and len(out) > base:
                last = out[-1]
                known = pairs.get(last * width + piece)
                fits = self.compatible(last, piece) if known is None else known
            if fits:
                out.append(piece)
                if end == stop:
                    return
                at, piece = end, longest[end]
                continue
            piece = shorter[piece]
            while piece < 0:  # no piece can stand here: take back the one before
                place = at - start
                failed[place >> 3] |= 1 << (place & 7)
                last = out.pop()
                at, piece = at - sizes[last], shorter[last]

    def encode(self, text: str) -> bytes:
        """The ids of a text with begin and end, packed."""
        begin, end = self.edges
        if not text:
            return begin + end
        text = BLANK + text.replace(" ", BLANK)
        if len(text) > WHOLE_TEXT:
            parts = (part.group() for part in self.cut.finditer(text))
        else:
            parts = self.cut.findall(text)
        return begin + b"".join(map(self.segments.__getitem__, parts)) + end

    def decode(self, packed: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become one replacement character each."""
        ids = memoryview(packed).cast("I") if packed else ()
        edge = sum(1 for _ in takewhile(lambda i: i in self.controls, ids))
        end = len(ids) - sum(1 for _ in takewhile(lambda i: i in self.controls, reversed(ids[edge:])))
        parts = [
            b"".join(map(self.surfaces.__getitem__, ids[at : min(at + DECODE_IDS, end)]))
            for at in range(edge, end, DECODE_IDS)
        ]
        blank = edge < end and self.pieces[ids[edge]].startswith(BLANK)
        try:
            return b"".join(parts)[blank:].decode()
        except UnicodeDecodeError:
            return self._decode_runs(ids[edge:end], blank)

    def _decode_runs(self, ids: memoryview, blank: bool) -> str:
        """Runs of bytes are decoded each for itself; other ids end a run, even without a text."""
        out = []
        for raw, run in groupby(ids, self.raw.__contains__):
            data = b"".join(self.surfaces[i] for i in run if i not in self.controls)
            out.append(_replaced(data) if raw else data.decode())
        return "".join(out)[blank:]


def _replaced(data: bytes) -> str:
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def encode_batches(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(vocabulary)
    for batch in batches:
        texts = batch.column("text")
        for low, high in slices(texts):
            packed, decoded = [], []
            for text in texts.slice(low, high - low):
                packed.append(encoder.encode(text.as_py() or ""))
                decoded.append(encoder.decode(packed[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(low, high - low), pa.array(packed, pa.binary()),
                 pa.array(decoded, pa.string())],
                ["doc_id", "ids", "decoded"],
            )


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """docs (doc_id, text) encoded with the model at path: doc_id, ids, decoded.

    ids are packed as little-endian unsigned 32-bit integers, begin and end included; decoded is
    their text. The model is read once on the driver and sent along (its size does not depend on
    the documents); no row is shuffled.

    Defined cases: a NULL text is the empty one, whose ids are begin and end. Repeated rows and
    ids are encoded each for itself, a NULL doc_id is kept. Texts of any length are encoded in
    linear time. No rows give no rows. Other columns are not read.
    """
    vocabulary = read_vocabulary(path)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        lambda it: encode_batches(it, vocabulary), "doc_id bigint, ids binary, decoded string"
    )


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encode_documents(docs, path).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
