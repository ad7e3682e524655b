"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is escaped and cut where no piece can reach across; each different part is encoded
once per task. Encoding keeps an agenda of the adjacent symbol pairs of all new parts and
takes, part by part, the pair of the best score, leftmost among equals, until no pair is a
piece. Every new part is checked against the sentencepiece library before it is used.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from stockloom.llm.words import slices

# As the library does, each byte of an invalid sequence becomes U+FFFD.
codecs.register_error("sentencepiece", lambda e: ("\ufffd" * (e.end - e.start), e.end))

MODEL = "piece_bpe_32k.model"
MARK = "▁"
# Characters of a part that is merged by itself.
LONG = 48
# Parts that a task remembers; the memory starts anew beyond that.
REMEMBERED = 600_000
# Ids that the remembered parts may hold, for very long parts.
REMEMBERED_IDS = 8_000_000


class Model:
    """Pieces of a merge-type model with byte fallback."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        pieces = [self.library.id_to_piece(i) for i in range(size)]
        special = [
            self.library.is_control(i) or self.library.is_unknown(i) for i in range(size)
        ]
        as_byte = [self.library.is_byte(i) for i in range(size)]
        if any(self.library.is_unused(i) for i in range(size)) or sum(as_byte) != 256:
            raise ValueError("only models with byte fallback and without unused pieces")
        self.byte_ids = np.zeros(256, dtype=np.int64)
        for i in np.flatnonzero(as_byte).tolist():
            self.byte_ids[int(pieces[i][3:5], 16)] = i
        self.ids = {p: i for i, p in enumerate(pieces) if not special[i] and not as_byte[i]}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece reaches across a space")
        self.cut_lines = not any("\n" in p for p in self.ids)
        self.scores = np.array([self.library.get_score(i) for i in range(size)])
        self.char_ids = np.full(0x110000, -1, dtype=np.int64)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.char_ids[ord(piece)] = i
        self._pairs(size)
        texts = [
            b"" if special[i]
            else bytes([int(p[3:5], 16)]) if as_byte[i]
            else p.replace(MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.text_data, self.text_bounds = _joined(texts)
        self.number_data, self.number_bounds = _joined([b"%d," % i for i in range(size)])

    def _pairs(self, size: int) -> None:
        """Sorted keys left * size + right of all pairs that make a piece, and the piece."""
        found = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    found[left * size + right] = i
        self.size = size
        self.pair_map = found
        self.pair_keys = np.array(sorted(found), dtype=np.int64)
        self.pair_ids = np.array([found[k] for k in sorted(found)], dtype=np.int64)

    def parts(self, text: str) -> list[str]:
        """The escaped text, cut before each run of marks and around each line break."""
        if not text:
            return []
        escaped = MARK + text.replace(" ", MARK)
        return (_LINES if self.cut_lines else _SPACES).findall(escaped)

    def agenda(self, symbols: list[int]) -> list[int]:
        """Merges of one long part: a heap of pairs by score, then place; stale ones are skipped."""
        count = len(symbols)
        before, after = list(range(-1, count - 1)), list(range(1, count + 1))
        heap: list[tuple[float, int, int, int]] = []

        def push(left: int, right: int) -> None:
            if left >= 0 and right < count and symbols[left] >= 0 and symbols[right] >= 0:
                merged = self.pair_map.get(symbols[left] * self.size + symbols[right])
                if merged is not None:
                    heappush(heap, (-self.scores[merged], left, symbols[left], symbols[right]))

        for left in range(count - 1):
            push(left, left + 1)
        gone = [False] * count
        while heap:
            _, left, first, second = heappop(heap)
            right = after[left]
            if gone[left] or right >= count or (symbols[left], symbols[right]) != (first, second):
                continue
            symbols[left] = self.pair_map[first * self.size + second]
            gone[right] = True
            after[left] = after[right]
            if after[left] < count:
                before[after[left]] = left
            push(before[left], left)
            push(left, after[left])
        return [s for s, out in zip(symbols, gone, strict=True) if not out]

    def merge(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts one after the other, and their number per part, by the agenda.

        Short parts take their steps side by side, one merge per part and round.
        """
        points = np.frombuffer("".join(parts).encode("utf-32-le"), dtype=np.uint32)
        owner = np.repeat(np.arange(len(parts)), [len(part) for part in parts])
        symbol = self.char_ids[points]
        # Characters that are no piece never merge; they keep their code point.
        strange = symbol < 0
        symbol[strange] = -1 - points[strange].astype(np.int64)
        done_symbols, done_owners = [], []
        sizes = np.bincount(owner, minlength=len(parts))
        ends = np.cumsum(sizes)
        for number in np.flatnonzero(sizes > LONG).tolist():
            own = symbol[ends[number] - sizes[number] : ends[number]]
            merged = np.array(self.agenda(own.tolist()), dtype=np.int64)
            done_symbols.append(merged)
            done_owners.append(np.full(len(merged), number))
        short = sizes[owner] <= LONG
        symbol, owner = symbol[short], owner[short]
        while len(symbol) > 1:
            merged, score = self._pair_scores(symbol, owner)
            best = np.full(len(parts), -np.inf)
            np.maximum.at(best, owner[:-1], score)
            # Leftmost pair of the best score in each part.
            at = np.flatnonzero((score == best[owner[:-1]]) & np.isfinite(score))
            if len(at) == 0:
                break
            first = np.ones(len(at), dtype=bool)
            first[1:] = owner[at[1:]] != owner[at[:-1]]
            at = at[first]
            symbol[at] = merged[at]
            stay = np.ones(len(symbol), dtype=bool)
            stay[at + 1] = False
            active = np.zeros(len(parts), dtype=bool)
            active[owner[at]] = True
            symbol, owner = symbol[stay], owner[stay]
            finished = ~active[owner]
            if finished.any():
                done_symbols.append(symbol[finished])
                done_owners.append(owner[finished])
                symbol, owner = symbol[~finished], owner[~finished]
        symbol = np.concatenate([*done_symbols, symbol])
        owner = np.concatenate([*done_owners, owner])
        order = np.argsort(owner, kind="stable")
        symbol, owner = symbol[order], owner[order]
        return self._with_bytes(symbol, owner, len(parts))

    def _pair_scores(self, symbol: np.ndarray, owner: np.ndarray):
        left, right = symbol[:-1], symbol[1:]
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        known = (
            (self.pair_keys[at] == keys) & (left >= 0) & (right >= 0) & (owner[:-1] == owner[1:])
        )
        merged = self.pair_ids[at]
        return merged, np.where(known, self.scores[merged], -np.inf)

    def _with_bytes(self, symbol: np.ndarray, owner: np.ndarray, count: int):
        """Strange characters become the ids of their bytes."""
        strange = np.flatnonzero(symbol < 0)
        spelled = [chr(-1 - i).encode() for i in symbol[strange].tolist()]
        widths = np.ones(len(symbol), dtype=np.int64)
        widths[strange] = [len(s) for s in spelled]
        ids = np.repeat(symbol, widths)
        ids[ids < 0] = self.byte_ids[np.frombuffer(b"".join(spelled), dtype=np.uint8)]
        lengths = np.bincount(np.repeat(owner, widths), minlength=count)
        return ids.astype(np.int32), lengths

    def check(self, parts: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Raises if the library encodes one of the parts otherwise.

        A line break before the part keeps it free of the mark that the library puts first.
        """
        lead = len(self.library.encode("\n"))
        expected = self.library.encode(["\n" + part for part in parts], num_threads=1)
        sizes = np.fromiter(map(len, expected), dtype=np.int64, count=len(parts)) - lead
        flat = np.fromiter(chain.from_iterable(e[lead:] for e in expected), dtype=np.int32)
        if not (np.array_equal(sizes, lengths) and np.array_equal(flat, ids)):
            raise ValueError("the library encodes a part otherwise than the agenda")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of the decoded ids, without the leading space that encoding adds."""
        data = _gather(ids, self.text_data, self.text_bounds).tobytes()
        return data.removeprefix(b" ").decode("utf-8", "sentencepiece").encode()

    def numbers(self, ids: np.ndarray) -> bytes:
        return _gather(ids, self.number_data, self.number_bounds).tobytes()[:-1]


_SPACES = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_LINES = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")


def _joined(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.cumsum([0, *map(len, values)])
    return np.frombuffer(b"".join(values), dtype=np.uint8), bounds


def _gather(ids: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The concatenation of the entries ``ids`` of a table of byte strings."""
    if len(ids) == 0:
        return data[:0]
    starts = bounds[ids]
    lengths = bounds[ids + 1] - starts
    ends = np.cumsum(lengths)
    return data[np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)]


class Encoder:
    """Encodes batches of texts; remembers the parts it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.flat = np.zeros(0, dtype=np.int32)
        self.bounds = np.zeros(1, dtype=np.int64)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        cut = [self.model.parts(text or "") for text in texts]
        if len(self.places) > REMEMBERED or len(self.flat) > REMEMBERED_IDS:
            self.forget()
        places = self.places
        new = list(dict.fromkeys(p for parts in cut for p in parts if p not in places))
        if new:
            ids, lengths = self.model.merge(new)
            self.model.check(new, ids, lengths)
            places.update(zip(new, range(len(places), len(places) + len(new)), strict=True))
            self.flat = np.concatenate([self.flat, ids])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(lengths)])
        out = []
        for parts in cut:
            at = np.fromiter(map(places.__getitem__, parts), dtype=np.int64, count=len(parts))
            out.append(_gather(at, self.flat, self.bounds))
        return out


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def _model(path: str | None) -> Model:
    return load(path or public_tokenizers.path(MODEL))


def _encode(path: str | None, columns: list[str], read_back: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        encoder = Encoder(model)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids = encoder.encode(part.column("text").to_pylist())
                bounds = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                arrays = [
                    *(part.column(name) for name in columns),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.astype(np.int32))),
                ]
                names = [*columns, "n_tokens", "token_ids"]
                if read_back:
                    texts = (model.decode_bytes(i) for i in ids)
                    arrays.append(pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()))
                    names.append("decoded_sha256")
                yield pa.record_batch(arrays, names)

    return run


def encoded(docs: DataFrame, path: str | None = None, read_back: bool = False) -> DataFrame:
    """``docs`` with n_tokens and token_ids, as the sentencepiece library encodes ``text``.

    Without begin and end ids, no sampling. A null or empty text has no ids. Columns of
    ``docs`` with the same names are replaced. With ``read_back``, the ids are decoded in
    the same task and decoded_sha256 is the digest of the text they give. ``path`` is the model's file, by default that
    of the public merge-type model, and must exist on every machine.
    """
    made = "n_tokens bigint, token_ids array<int>" + (", decoded_sha256 string" if read_back else "")
    new = [part.split()[0] for part in made.split(", ")]
    columns = [c for c in docs.columns if c not in new]
    kept = docs.select(*columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(_encode(path, columns, read_back), f"{schema}, {made}")


def _decode(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for batch in batches:
            texts = [
                None if ids is None else model.decode_bytes(np.array(ids, dtype=np.int64)).decode()
                for ids in batch.column("token_ids").to_pylist()
            ]
            yield pa.record_batch(
                [*batch.columns, pa.array(texts, pa.string())],
                [*batch.schema.names, "decoded"],
            )

    return run


def decoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with the text of ``token_ids`` as ``decoded``; null ids give null."""
    kept = docs.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(_decode(path), f"{schema}, decoded string")


def _digests(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        encoder = Encoder(model)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids = encoder.encode(part.column("text").to_pylist())
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        pa.array([len(i) for i in ids], pa.int64()),
                        pa.array([hashlib.sha256(model.numbers(i)).hexdigest() for i in ids]),
                        pa.array([hashlib.sha256(model.decode_bytes(i)).hexdigest() for i in ids]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return run


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids and of the decoded text, without keeping either."""
    return docs.select("doc_id", "text").mapInArrow(
        _digests(path),
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )
