"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

A text is encoded as the model's byte-pair merges would: the best-scored candidate merge on an agenda is taken first,
the leftmost of equals. With dropout, a candidate that comes up is skipped if the keyed hash of the seed, the place of
its left part and its merged piece falls below the rate, so a text gets one of many segmentations into pieces of
the vocabulary, always the same one for the same seed. Characters without a piece become byte pieces.

A text is cut where no piece can cross (before a run of blanks, around line ends; checked against the vocabulary),
and the parts are encoded on their own. The hash of a candidate takes the document's id and the part's number in the
text as well, so every occurrence of a word draws for itself. A worker remembers what comes up on the agenda of a part
when nothing is skipped; an occurrence none of whose candidates is skipped has those tokens, and only the others run
agendas of their own.

Defined results: a null text has null tokens, an empty one none. Decoding gives back every text byte for byte, also blanks
at the ends, control characters, the meta symbol itself and characters outside the vocabulary. Ties between candidates
are broken by place. Rows are encoded on their own: rows with equal id and text are encoded alike, a null id counts as 0. Other
columns are kept, those named ``tokens``, ``n_tokens`` or ``lossless`` are replaced.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructType

from termfold.llm.arrays import list_column, received, slices

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
#: Bytes of text, and parts of it, that are encoded together.
BYTES_TOGETHER = 1 << 18
PARTS_TOGETHER = 1 << 16
META = "▁"
#: Parts that a worker remembers, of at most ``WIDEST`` characters.
REMEMBERED = 100_000
WIDEST = 64
_MASK = (1 << 64) - 1
_PLACE, _PIECE, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9
_SYMBOLS = 1 << 22
_HASH_BITS = 20
#: Order of a pair of symbols that is no candidate; orders are multiples of ``WIDEST``, so that a place can be added.
_NONE = 1 << 30
_PLACE_BITS = WIDEST.bit_length() - 1


def _stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def document_key(seed: int, doc_id: object) -> int:
    """Key of a document; ids that are no integers count by their CRC-32."""
    number = doc_id if isinstance(doc_id, int) else zlib.crc32(str(doc_id).encode()) if doc_id is not None else 0
    x = (seed * 0x9E3779B97F4A7C15 + (number + 1) * 0xD1B54A32D192ED03) & _MASK
    return int(_stirred(np.array([x], np.uint64))[0])


def occurrence_keys(documents: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Keys of the parts at ``places`` of documents with these keys."""
    return _stirred(documents + (places.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA0761D6478BD642F))


def _hashes(keys: np.ndarray, left: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Hash of each candidate, below 2**32: the place of its left part and the piece it would make."""
    x = (keys ^ (left.astype(np.uint64) * np.uint64(_PLACE))) + piece.astype(np.uint64) * np.uint64(_PIECE)
    return ((x ^ (x >> np.uint64(32))) * np.uint64(_MIX)) >> np.uint64(32)


class Pieces:
    """A BPE model of the SentencePiece library: encoder with dropout, and decoder."""

    def __init__(self, model: bytes):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.bytes_of: list[bytes] = []
        byte_ids = [0] * 256
        for i in range(own.get_piece_size()):
            piece = own.id_to_piece(i)
            if own.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif own.is_control(i) or own.is_unknown(i) or own.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.rank[piece], self.id[piece] = -own.get_score(i), i
                self.bytes_of.append(piece.replace(META, " ").encode())
        self.byte_ids = byte_ids
        self._tables()
        blanks_inside = any(META in piece.lstrip(META) for piece in self.rank)
        lines_inside = any("\n" in piece for piece in self.rank if len(piece) > 1)
        if blanks_inside:
            pattern = r"[\s\S]+"
        elif lines_inside:
            pattern = rf"{META}*[^{META}]+|{META}+"
        else:
            pattern = rf"{META}*[^{META}\n]+|{META}+|\n"
        self.parts = re.compile(pattern).findall

    def _tables(self) -> None:
        """The vocabulary as arrays: symbols of code points, mergeable pairs of symbols, bytes of pieces."""
        size = len(self.bytes_of)
        self.symbol_of = np.arange(0x110000, dtype=np.int32) + size  # a character without a piece
        for piece, i in self.id.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = i
        pairs = {}
        for piece, i in self.id.items():
            for cut in range(1, len(piece)):
                left, right = self._symbol(piece[:cut]), self._symbol(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * _SYMBOLS + right] = i
        # Pairs in order of a hash, the places where each hash begins, and a last pair that there is not.
        keys = np.array(sorted(pairs), np.int64)
        hashes = self._hash(keys)
        by_hash = np.argsort(hashes, kind="stable")
        self.pairs = np.append(keys[by_hash], np.int64(-1))
        self.first_of = np.searchsorted(hashes[by_hash], np.arange((1 << _HASH_BITS) + 1)).astype(np.int32)
        self.merged = np.array([pairs[key] for key in keys[by_hash].tolist()] + [-1], np.int32)
        rank_of = {i: self.rank[piece] for piece, i in self.id.items()}
        # Ranks as whole numbers in the same order, and the piece of each, -1 if several pieces share it.
        ranks, order = np.unique([rank_of[i] for i in self.merged[:-1].tolist()], return_inverse=True)
        self.pair_order = np.append(order << _PLACE_BITS, _NONE).astype(np.int32)
        self.piece_of = np.zeros(len(ranks), np.int32)
        self.piece_of[order] = self.merged[:-1]
        self.piece_of[order[self.piece_of[order] != self.merged[:-1]]] = -1
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.places = np.concatenate(([0], np.cumsum(self.lengths)))
        self.spelling = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def _symbol(self, piece: str) -> int | None:
        found = self.id.get(piece)
        return found if found is not None or len(piece) > 1 else len(self.bytes_of) + ord(piece)

    @staticmethod
    def _hash(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(_PLACE)) >> np.uint64(64 - _HASH_BITS)).astype(np.int64)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair of symbols in ``pairs``, the last place if it has none."""
        keys = left.astype(np.int64) * _SYMBOLS + right
        hashes = self._hash(keys)
        at = self.first_of[hashes]
        met = self.pairs[at] == keys
        found = np.where(met, at, len(self.pairs) - 1)
        open_ = np.flatnonzero(~met.ravel())
        at, ends, keys = at.ravel()[open_], self.first_of[hashes.ravel()[open_] + 1], keys.ravel()[open_]
        flat = found.reshape(-1)
        while True:
            at = at + 1
            more = at < ends
            open_, at, ends, keys = open_[more], at[more], ends[more], keys[more]
            if not len(open_):
                return found
            met = self.pairs[at] == keys
            flat[open_[met]] = at[met]

    def segmented_together(
        self, parts: list[str], keys: np.ndarray, threshold: int = 0, candidates: bool = True
    ) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of each part as bytes of 32-bit numbers, and the candidates as of :meth:`together`."""
        tokens, sizes, *came = self.together(parts, keys, threshold, candidates)
        data, ends = tokens.tobytes(), (np.cumsum(sizes) * 4).tolist()
        return [data[start:end] for start, end in zip([0, *ends], ends)], *came

    def together(
        self, parts: list[str], keys: np.ndarray, threshold: int = 0, candidates: bool = True
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of many parts, one after the other, and their number: the agendas of all advance by one candidate at a time.

        Also the candidates that were taken or skipped: part, place and piece of each, in order for each part of at most
        ``WIDEST`` characters; none if they are not asked for.
        """
        came = [(np.zeros(0, np.int32),) * 3]
        done = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        widths = np.maximum(4, 1 << np.frexp(np.maximum(lengths - 1, 0))[1])
        if len(self.pairs) == 1:
            widths[:] = 2 * WIDEST
        for i in np.flatnonzero(widths > WIDEST).tolist():
            alone = np.array(self.ids(self.segmented(parts[i], int(keys[i]), threshold)), np.int32)
            done.append((np.array([i]), np.array([len(alone)]), alone))
        rows = np.flatnonzero(widths <= WIDEST)
        rows = rows[np.argsort(widths[rows], kind="stable")]
        low = 0
        while low < len(rows):
            width = int(widths[rows[low]])
            high = min(low + (1 << 17) // width, int(np.searchsorted(widths[rows], width, "right")))
            some = rows[low:high]
            self._advance([parts[i] for i in some.tolist()], lengths[some], width, keys[some], threshold, some, done, came if candidates else None)
            low = high
        of, counts, tokens = (np.concatenate(x) for x in zip(*done))
        sizes, starts = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        sizes[of], starts[of] = counts, np.cumsum(counts) - counts
        tokens = _picked(tokens, starts, sizes)
        part, place, piece = (np.concatenate(x) for x in zip(*came))
        order = np.argsort(part, kind="stable")
        return *self._spelled(tokens, sizes), part[order], place[order], piece[order]

    def _advance(
        self, parts: list[str], lengths: np.ndarray, width: int, keys: np.ndarray, threshold: int, numbers: np.ndarray, done: list[tuple], came: list[tuple] | None
    ) -> None:
        """The matrices have a column for each part and a row for each place, and a last row that never holds a symbol."""
        n = len(parts)
        at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = at * n + np.repeat(np.arange(n), lengths)
        text = self.symbol_of[np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)]
        symbols = np.full((width + 1, n), -1, np.int32)
        symbols.reshape(-1)[at] = text
        # The candidate at each place: its order and, in the lowest bits, the place.
        orders = np.full((width + 1, n), _NONE, np.int32)
        first = np.cumsum(lengths)[:-1]
        joined = self.pair_order[self._pair(text[:-1], text[1:])]
        joined[first[(first > 0) & (first < len(text))] - 1] = _NONE
        orders.reshape(-1)[at[:-1]] = joined + at[:-1] // n
        after = np.repeat(np.arange(1, width + 2, dtype=np.int32)[:, None], n, 1)
        before = after - np.int32(2)
        before[0] = width
        rows = np.arange(n)
        while True:
            best = orders[:width].min(0)
            index = np.flatnonzero(best < _NONE)
            # Parts that are done leave when they are many, not one by one.
            if 8 * len(index) < 7 * n:
                closed = np.flatnonzero(best >= _NONE)
                left = symbols[:width, closed].T
                filled = left >= 0
                done.append((numbers[rows[closed]], filled.sum(1), left[filled]))
                rows, best, n = rows[index], best[index], len(index)
                symbols, orders, after, before = (x.take(index, 1) for x in (symbols, orders, after, before))
                index = np.arange(n)
            if not len(index):
                if n:
                    left = symbols[:width].T
                    filled = left >= 0
                    done.append((numbers[rows], filled.sum(1), left[filled]))
                return
            flat_symbols, flat_orders, flat_after, flat_before = (x.reshape(-1) for x in (symbols, orders, after, before))
            best = best[index]
            place = best & (WIDEST - 1)
            here = place * np.int64(n) + index
            into = self.piece_of[best >> _PLACE_BITS]
            shared = np.flatnonzero(into < 0)
            if len(shared):
                right = flat_symbols[flat_after[here[shared]] * np.int64(n) + index[shared]]
                into[shared] = self.merged[self._pair(flat_symbols[here[shared]], right)]
            if came is not None:
                came.append((numbers[rows[index]].astype(np.int32), place, into))
            if threshold:
                skipped = _hashes(keys[rows[index]], place, into) < threshold
                flat_orders[here[skipped]] = _NONE
                taken = ~skipped
                index, place, here, into = index[taken], place[taken], here[taken], into[taken]
                if not len(index):
                    continue
            # The right part goes; what stands behind it comes after the left one.
            gone = flat_after[here] * np.int64(n) + index
            following = flat_after[gone]
            behind = following * np.int64(n) + index
            previous = flat_before[here]
            ahead = previous * np.int64(n) + index
            flat_symbols[here], flat_symbols[gone], flat_orders[gone] = into, -1, _NONE
            flat_after[here], flat_before[behind] = following, place
            # A place without a symbol is in no pair.
            found = self.pair_order[
                self._pair(np.concatenate((flat_symbols[ahead], into)), np.concatenate((into, flat_symbols[behind])))
            ]
            flat_orders[ahead] = found[: len(index)] + previous
            flat_orders[here] = found[len(index) :] + place

    def _spelled(self, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens with the bytes of characters without a piece in their places, and the new sizes."""
        at = np.flatnonzero(tokens >= len(self.bytes_of))
        if not len(at):
            return tokens, sizes
        spelled = [[self.byte_ids[b] for b in chr(symbol - len(self.bytes_of)).encode()] for symbol in tokens[at].tolist()]
        widths = np.ones(len(tokens), np.int64)
        widths[at] = list(map(len, spelled))
        ends = np.concatenate(([0], np.cumsum(widths)))
        out = np.repeat(tokens, widths)
        out[np.repeat(tokens >= len(self.bytes_of), widths)] = [token for some in spelled for token in some]
        bounds = ends[np.concatenate(([0], np.cumsum(sizes)))]
        return out, np.diff(bounds)

    def segmented(self, part: str, key: int = 0, threshold: int = 0) -> list[str]:
        """Pieces of one part; candidates whose hash is below ``threshold`` of 2**32 are skipped."""
        pieces: list[str | None] = list(part)
        n = len(pieces)
        rank = self.rank
        agenda = []
        for i in range(n - 1):
            found = rank.get(part[i : i + 2])
            if found is not None:
                agenda.append((found, i, i + 1, 2))
        if not agenda:
            return pieces
        heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            _, left, right, size = heappop(agenda)
            a, b = pieces[left], pieces[right]
            if a is None or b is None or len(a) + len(b) != size:
                continue
            if threshold:
                x = ((key ^ ((left * _PLACE) & _MASK)) + self.id[a + b] * _PIECE) & _MASK
                x = ((x ^ (x >> 32)) * _MIX) & _MASK
                if x >> 32 < threshold:
                    continue
            merged = pieces[left] = a + b
            pieces[right] = None
            following = after[left] = after[right]
            if following < n:
                before[following] = left
                found = rank.get(merged + pieces[following])
                if found is not None:
                    heappush(agenda, (found, left, following, size + len(pieces[following])))
            previous = before[left]
            if previous >= 0:
                found = rank.get(pieces[previous] + merged)
                if found is not None:
                    heappush(agenda, (found, previous, left, size + len(pieces[previous])))
        return [piece for piece in pieces if piece is not None]

    def ids(self, pieces: list[str]) -> list[int]:
        out = []
        for piece in pieces:
            found = self.id.get(piece)
            if found is not None:
                out.append(found)
            else:
                out += [self.byte_ids[b] for b in piece.encode()]
        return out

    def spelled_out(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all tokens one after the other, and the n + 1 bounds of each."""
        lengths = self.lengths[tokens]
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        at = np.repeat(self.places[tokens] - bounds[:-1], lengths) + np.arange(bounds[-1])
        return self.spelling[at], bounds

    def decoded(self, tokens: list[int]) -> str:
        return self.spelled_out(np.array(tokens, np.int64))[0][1:].tobytes().decode("utf-8", "replace")


def _picked(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of ``values``, one after the other."""
    return values[np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)]


class Memory:
    """Parts with their tokens and candidates when nothing is skipped."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.tokens, self.bounds = array("i"), array("i", [0])
        self.starts, self.places, self.into = array("i", [0]), array("B"), array("i")

    def add(self, parts: list[str], tokens: np.ndarray, sizes: np.ndarray, part: np.ndarray, place: np.ndarray, piece: np.ndarray) -> None:
        """``part, place, piece``: the candidates, ordered by part."""
        self.number.update(zip(parts, range(len(self.number), len(self.number) + len(parts))))
        self.tokens.frombytes(tokens.astype(np.int32).tobytes())
        self.bounds.frombytes((np.cumsum(sizes) + self.bounds[-1]).astype(np.int32).tobytes())
        ends = np.searchsorted(part, np.arange(len(parts)), "right") + self.starts[-1]
        self.starts.frombytes(ends.astype(np.int32).tobytes())
        self.places.frombytes(place.astype(np.uint8).tobytes())
        self.into.frombytes(piece.astype(np.int32).tobytes())

    def numbers(self, parts: list[str]) -> np.ndarray:
        return np.fromiter(map(self.number.get, parts, repeat(-1)), np.int64, len(parts))

    def skipping(self, numbers: np.ndarray, keys: np.ndarray, threshold: int) -> np.ndarray:
        """Which occurrences skip one of their part's candidates."""
        starts, places, into = (np.frombuffer(x, x.typecode) for x in (self.starts, self.places, self.into))
        sizes = starts[numbers + 1] - starts[numbers]
        of = np.repeat(np.arange(len(numbers)), sizes)
        at = np.arange(len(of)) + np.repeat(starts[numbers] - np.cumsum(sizes) + sizes, sizes)
        skipped = _hashes(keys[of], places[at], into[at]) < threshold
        return np.bincount(of[skipped], minlength=len(numbers)) > 0


class Encoder:
    """Encodes texts, remembering the parts it has met."""

    def __init__(self, model: bytes, dropout: float, seed: int):
        self.pieces = Pieces(model)
        self.seed = seed
        self.threshold = int(min(max(dropout, 0.0), 1.0) * (1 << 32))
        self.memory = Memory()
        self.meta = np.array([self.pieces.byte_ids[b] for b in META.encode()], np.int32)

    def __call__(self, texts: list[str | None], ids: list) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts one after the other, and their n + 1 bounds."""
        parts, counts, spelled = [], [], []
        for text in texts:
            own, metas = self._parts(text) if text else ([], [])
            spelled += [len(parts) + at for at in metas]
            parts += own
            counts.append(len(own))
        counts = np.array(counts, np.int64)
        documents = np.array([document_key(self.seed, i) for i in ids], np.uint64)
        starts = np.cumsum(counts) - counts
        places = np.arange(len(parts)) - np.repeat(starts, counts)
        keys = occurrence_keys(np.repeat(documents, counts), places)
        runs = [(np.zeros(0, np.int32), np.zeros(0, np.int64))]
        for low in range(0, len(parts), PARTS_TOGETHER):
            runs.append(self._tokens(parts[low : low + PARTS_TOGETHER], keys[low : low + PARTS_TOGETHER]))
        tokens, sizes = (np.concatenate(x) for x in zip(*runs))
        if spelled:
            before = np.cumsum(sizes)[spelled]
            tokens = np.insert(tokens, np.repeat(before, len(self.meta)), np.tile(self.meta, len(before)))
            sizes[spelled] = len(self.meta)
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        return tokens, bounds[np.append(starts, len(parts))]

    def _tokens(self, parts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all parts one after the other, and the number of each part's."""
        if len(self.memory.number) > REMEMBERED:
            self.memory = Memory()
        numbers = self.memory.numbers(parts)
        unknown = np.flatnonzero(numbers < 0)
        unmet = [parts[i] for i in unknown.tolist()]
        new = [part for part in dict.fromkeys(unmet) if len(part) <= WIDEST]
        if new:
            self.memory.add(new, *self.pieces.together(new, np.zeros(len(new), np.uint64)))
            numbers[unknown] = self.memory.numbers(unmet)
        own = numbers < 0
        if self.threshold:
            known = np.flatnonzero(~own)
            own[known] = self.memory.skipping(numbers[known], keys[known], self.threshold)
        again, known = np.flatnonzero(own), np.flatnonzero(~own)
        drawn, counts, *_ = self.pieces.together([parts[i] for i in again.tolist()], keys[again], self.threshold, candidates=False)
        remembered, bounds = (np.frombuffer(x, np.int32) for x in (self.memory.tokens, self.memory.bounds))
        starts, sizes = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        starts[known] = bounds[numbers[known]]
        sizes[known] = bounds[numbers[known] + 1] - starts[known]
        starts[again], sizes[again] = len(remembered) + np.cumsum(counts) - counts, counts
        return _picked(np.concatenate((remembered, drawn)), starts, sizes), sizes

    def _parts(self, text: str) -> tuple[list[str], list[int]]:
        """Parts of a text, and the places where the meta symbol itself stands: it is spelled in bytes."""
        if META not in text:
            return self.pieces.parts(META + text.replace(" ", META)), []
        runs = text.split(META)
        parts, spelled = self.pieces.parts((META + runs[0]).replace(" ", META)), []
        for run in runs[1:]:
            spelled.append(len(parts))
            parts += ["", *self.pieces.parts(run.replace(" ", META))]
        return parts, spelled


def read_model(path: str = TOKENIZER) -> bytes:
    with open(path, "rb") as file:
        return file.read()


_encoders: dict[tuple, Encoder] = {}


def encode(
    docs: DataFrame,
    model: bytes,
    dropout: float = DROPOUT,
    seed: int = 0,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``docs`` with ``tokens``, ``n_tokens`` and ``lossless`` (whether the tokens decode to the text) of whole texts."""
    added = DataType.fromDDL("tokens array<int>, n_tokens long, lossless boolean")
    kept = docs.select(*[docs[c] for c in docs.columns if c.lower() not in added.names])
    names = [c.lower() for c in kept.columns]
    at, id_at = names.index(text), names.index(doc_id)
    schema = StructType([*kept.schema.fields, *added.fields])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = (hash(sent.value), dropout, seed)
        encoder = _encoders.get(name)
        if encoder is None:
            _encoders.clear()
            encoder = _encoders[name] = Encoder(sent.value, dropout, seed)
        try:
            for batch in received(batches):
                for low, high, _, _ in slices(batch.column(at), BYTES_TOGETHER):
                    part = batch.slice(low, high - low)
                    texts = part.column(at).to_pylist()
                    joined, ends = encoder(texts, part.column(id_at).to_pylist())
                    spelled, bounds = encoder.pieces.spelled_out(joined)
                    # Without the blank that the encoder puts before every text.
                    back = [spelled[bounds[a] + 1 : bounds[b]].tobytes() for a, b in zip(ends[:-1], ends[1:])]
                    lossless = [None if t is None else t.encode() == b for t, b in zip(texts, back)]
                    lists = _nulled(list_column(joined, ends), texts)
                    columns = [lists, pa.array([None if t is None else int(x) for t, x in zip(texts, np.diff(ends))], pa.int64()), pa.array(lossless, pa.bool_())]
                    yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=schema.names)
                batch = part = None
        finally:
            # The worker may wait long for its next task, and other workers for theirs beside it.
            encoder.memory = Memory()

    return kept.mapInArrow(task, schema)


def _nulled(lists: pa.ListArray, texts: list[str | None]) -> pa.Array:
    """The lists, null where the text is null."""
    if None not in texts:
        return lists
    empty = pa.array([t is None for t in texts])
    return pa.ListArray.from_arrays(lists.offsets, lists.values, mask=empty)


def decode(tokens: DataFrame, model: bytes, column: str = "tokens") -> DataFrame:
    """``tokens`` with the column ``text`` that its tokens spell; null tokens give a null text."""
    added = DataType.fromDDL("text string")
    kept = tokens.select(*[tokens[c] for c in tokens.columns if c.lower() != "text"])
    at = [c.lower() for c in kept.columns].index(column)
    schema = StructType([*kept.schema.fields, *added.fields])
    sent = tokens.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(sent.value)
        for batch in batches:
            texts = [None if t is None else pieces.decoded(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return kept.mapInArrow(task, schema)


def op3_pieces(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, read_model()).drop("text")
