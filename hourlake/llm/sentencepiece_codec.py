"""Operator 1: SentencePiece encoding and decoding that keeps byte offsets.

The text is normalised by longest-prefix matches in the model's compiled character map while the
source position of every normalised character is recorded; the pieces that byte-pair merging finds
in the normalised text are projected through that record to byte spans of the original text.
"""

from __future__ import annotations

import re
import struct
import sys
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from hourlake.llm.bpe import BITS, Memo, forget, give_back, merge, merge_all, pair_arrays, pair_value, release

#: Units that are merged at once; each of their characters takes some 100 bytes meanwhile.
UNITS_AT_ONCE = 30_000

# The sign that stands for a space, and the piece kinds of a model file.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class CharacterMap:
    """A compiled character map: a double-array trie of source strings with their replacements."""

    def __init__(self, blob: bytes):
        self.units: list[int] = []
        self.texts = b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
            self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest source string that begins at `at`, or None."""
        if not self.units:
            return None
        found, units = None, self.units
        step = lambda unit: (unit >> 10) << ((unit & 0x200) >> 6)
        node = step(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= step(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        return found and (found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])])


class _Symbols(dict):
    """Numbers of characters; one number that merges with nothing for all that no piece has."""

    def __missing__(self, key: str) -> int:
        return (1 << BITS) - 1


class UnitPieces(Memo):
    """Numbers of the units that texts are cut into, and the pieces of each in one array for all.

    A unit gets its number as it is first looked up; learn() then makes the pieces of all new ones at once. Of a full table those units stay that were met again.
    """

    def __init__(self, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]], most: int = 150_000, longest: int = 64):
        super().__init__(make, most, longest)
        self.clear()

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self)
        return number

    def clear(self) -> None:
        super().clear()
        # For each unit, where its pieces begin, their number, its characters and how often it was met; and rows of ids, source bytes and characters of pieces.
        self.at, self.n, self.chars, self.met = (np.empty(0, np.int64) for _ in range(4))
        self.pieces = np.empty((3, 0), np.uint32)

    def learn(self, numbers: list[np.ndarray]) -> Callable[[np.ndarray], np.ndarray]:
        """Make the pieces of all new units; numbers are those of all units since then, to be counted. Gives a function from numbers to pieces that outlives changes."""
        new = list(islice(self, len(self.at), None))
        if new:
            at, n, pieces = self.make(new)
            self.at, self.n = np.append(self.at, at + self.pieces.shape[1]), np.append(self.n, n)
            self.chars = np.append(self.chars, np.fromiter(map(len, new), np.int64, len(new)))
            self.met = np.append(self.met, np.zeros(len(new), np.int64))
            self.pieces = np.concatenate([self.pieces, pieces], axis=1)
        if numbers:
            self.met += np.bincount(np.concatenate(numbers), minlength=len(self.met))
        return partial(_gather, self.at, self.n, self.pieces)

    def trim(self) -> None:
        """Make room in a full table."""
        if len(self) <= self.most and self.chars.sum() <= 32 * self.most:
            return
        keep = np.flatnonzero((self.met > 1) & (self.chars <= self.longest))
        keep = np.sort(keep[np.argsort(-self.met[keep], kind="stable")[: self.most // 2]])
        units, at, n, chars, met = list(self), self.at[keep], self.n[keep], self.chars[keep], self.met[keep]
        pieces = _gather(self.at, self.n, self.pieces, keep)
        self.clear()
        self.update((units[k], number) for number, k in enumerate(keep.tolist()))
        self.at, self.n, self.chars, self.met, self.pieces = np.cumsum(n) - n, n, chars, met // 2, pieces


def _gather(at: np.ndarray, n: np.ndarray, pieces: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Rows of ids, source bytes and characters of the pieces of units, behind one another."""
    n = n[numbers]
    ends = np.cumsum(n)
    return pieces[:, np.repeat(at[numbers] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


class SentencePieceCodec:
    """Encodes and decodes as the library does with the same BPE model, and gives byte spans."""

    def __init__(self, path: str):
        proto = model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or proto.trainer_spec.treat_whitespace_as_suffix or proto.trainer_spec.pretokenization_delimiter:
            raise ValueError(f"{path} is no plain BPE model")
        if any(p.type in (USER_DEFINED, UNUSED) for p in proto.pieces):
            raise ValueError(f"{path} has user-defined or unused pieces")
        self.map = CharacterMap(norm.precompiled_charsmap)
        self.dummy, self.trim, self.escape = norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces
        self.bos, self.eos, self.unk = proto.trainer_spec.bos_id, proto.trainer_spec.eos_id, proto.trainer_spec.unk_id
        self.unk_surface = proto.trainer_spec.unk_surface
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.kinds = [p.type for p in proto.pieces]
        byte_of = {i: bytes([b]) for b, i in self.bytes.items()}
        self.surface = [
            byte_of[i] if p.type == BYTE else b"" if p.type == CONTROL else self.unk_surface.encode() if p.type == UNKNOWN else p.piece.replace(SPACE, " ").encode()
            for i, p in enumerate(proto.pieces)
        ]
        symbols = dict(self.ids)
        for c in {c for p in self.ids for c in p}:
            symbols.setdefault(c, len(proto.pieces) + len(symbols))
        ranks = {s: k for k, s in enumerate(sorted({-p.score for p in proto.pieces}))}
        self.table = {
            symbols[p[:i]] << BITS | symbols[p[i:]]: pair_value(ranks[-proto.pieces[n].score], n)
            for p, n in self.ids.items()
            for i in range(1, len(p))
            if p[:i] in symbols and p[i:] in symbols
        }
        self.pairs = pair_arrays(self.table)
        self.symbols = _Symbols({c: s for c, s in symbols.items() if len(c) == 1})
        self.numbers = np.full(sys.maxunicode + 1, self.symbols[""], np.int32)
        self.numbers[list(map(ord, self.symbols))] = list(self.symbols.values())
        self.pieces = len(proto.pieces)
        # Merges never join two characters that are adjacent in no piece, so a text may be cut there.
        self.joins = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        cut = not any(pair[0] != SPACE and pair[1] == SPACE or "\n" in pair for pair in self.joins)
        self.units = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if cut else "(?s:.+)")
        self.unit_pieces = UnitPieces(self._pieces)

    # -- normalisation

    def normalise(self, text: str) -> tuple[str, list[int]]:
        """The normalised text, and for each of its characters and its end the byte offset in the source."""
        data = text.encode("utf-8")
        out: list[str] = []
        starts: list[int] = []
        at, n = 0, len(data)

        def one(at: int) -> tuple[int, str]:
            if hit := self.map.longest(data, at):
                return hit[0], hit[1].decode("utf-8")
            lead = data[at]
            size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return size, data[at : at + size].decode("utf-8")

        sign = SPACE if self.escape else " "
        if self.trim:
            while at < n and (hit := one(at))[1] == " ":
                at += hit[0]
        if at >= n:
            return "", [n]
        if self.dummy:
            out.append(sign)
            starts.append(at)
        spaced = self.trim
        while at < n:
            size, new = one(at)
            while spaced and new.startswith(" "):
                new = new[1:]
            for c in new:
                out.append(sign if c == " " else c)
                starts.append(at)
            if new:
                spaced = self.trim and new.endswith(" ")
            at += size
        end = n
        if self.trim:
            while out and out[-1] == sign:
                out.pop()
                end = starts.pop()
        return "".join(out), [*starts, end]

    # -- pieces

    def _pieces(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the pieces of each unit begin, their number, and rows of ids, of the source bytes each takes if no character was mapped, and of its characters."""
        at, n = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        parts, made = [], 0
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        short = np.flatnonzero(lengths <= self.unit_pieces.longest)
        own: dict[int, tuple[list[int], list[int]]] = {}  # ids and starts of pieces of units that go one by one
        for k in np.flatnonzero(lengths > self.unit_pieces.longest).tolist():
            symbols = merge(list(map(self.symbols.__getitem__, units[k])), self.table)[0]
            starts = [i for i, s in enumerate(symbols) if s >= 0]
            own[k] = [symbols[i] for i in starts], [*starts, len(units[k])]
        for first in range(0, len(short), UNITS_AT_ONCE):
            some = short[first : first + UNITS_AT_ONCE]
            n[some], pieces, odd = self._merged([units[k] for k in some.tolist()])
            at[some] = made + np.cumsum(n[some]) - n[some]
            own |= {int(some[k]): found for k, found in odd.items()}
            parts.append(pieces)
            made += pieces.shape[1]
        for k, (symbols, starts) in own.items():
            parts.append(self._mixed(units[k], symbols, starts))
            at[k], n[k] = made, parts[-1].shape[1]
            made += n[k]
        return at, n, np.concatenate(parts, axis=1)

    def _merged(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, dict[int, tuple[list[int], list[int]]]]:
        """Numbers of pieces and their rows for units that are merged at once; besides, ids and starts of those units that have characters which no piece has."""
        codes = np.frombuffer("".join(units).encode("utf-32-le"), "<u4")
        own = np.repeat(np.arange(len(units)), np.fromiter(map(len, units), np.int64, len(units)))
        # One place before, between and behind the units holds the number that merges with nothing.
        places = np.arange(len(codes)) + own + 1
        symbols, owner = np.full(len(codes) + len(units) + 1, self.symbols[""], np.int64), np.full(len(codes) + len(units) + 1, -1)
        symbols[places], owner[places] = self.numbers[codes], own
        symbols = merge_all(symbols, owner, self.pairs)[places]
        starts = np.flatnonzero(symbols >= 0)
        ids, own = symbols[starts], own[starts]
        width = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        width[codes == ord(SPACE)] = 1
        n = np.bincount(own, minlength=len(units))
        pieces = np.stack([ids, np.add.reduceat(width, starts), np.diff(starts, append=len(codes))]).astype(np.uint32)
        ends, odd = np.cumsum(n), {}
        for k in dict.fromkeys(own[ids >= self.pieces].tolist()):
            of = slice(ends[k] - n[k], ends[k])
            odd[k] = ids[of].tolist(), [*(starts[of] - starts[of][0]).tolist(), len(units[k])]
        return n, pieces, odd

    def _mixed(self, unit: str, symbols: list[int], starts: list[int]) -> np.ndarray:
        """Rows of pieces of a unit that may have characters which no piece has."""
        ids, sizes, chars = [], [], []
        for k, symbol in enumerate(symbols):
            piece = unit[starts[k] : starts[k + 1]]
            if symbol < self.pieces:
                ids.append(symbol)
            elif self.bytes:
                raw = piece.encode("utf-8")
                ids += [self.bytes[b] for b in raw]
                sizes += [0] * (len(raw) - 1)
                chars += [0] * (len(raw) - 1)
            else:
                ids.append(self.unk)
            sizes.append(len(piece.replace(SPACE, " ").encode("utf-8")))
            chars.append(len(piece))
        return np.array([ids, sizes, chars], np.uint32)

    def encode(self, text: str, bos: bool = True, eos: bool = True) -> tuple[bytes, bytes]:
        """Packed ids, and packed ends of the pieces' byte spans in the text; a span starts where the last ended.

        Both are little-endian unsigned 32-bit integers. All byte pieces of a character but the last have empty spans.
        """
        return next(self.encode_all([text], bos, eos))

    def encode_all(self, texts: Iterable[str], bos: bool = True, eos: bool = True) -> Iterator[tuple[bytes, bytes]]:
        """encode of each text. Units that no text before them had are merged at once for all texts."""
        plain = not self.map.units and not self.trim and self.escape
        table, rows = self.unit_pieces, []
        table.trim()
        try:
            for text in texts:
                if plain:
                    normal, starts = (SPACE if self.dummy and text else "") + text.replace(" ", SPACE), None
                else:
                    normal, starts = self.normalise(text)
                rows.append((text, starts, np.fromiter(map(table.__getitem__, self.units.findall(normal)), np.int32)))
            pieces = table.learn([numbers for _, _, numbers in rows])
        except BaseException:
            table.clear()  # some units have a number and no pieces
            raise
        for text, starts, numbers in rows:
            yield self._packed(text, starts, pieces(numbers), bos, eos)

    def _packed(self, text: str, starts: list[int] | None, pieces: np.ndarray, bos: bool, eos: bool) -> tuple[bytes, bytes]:
        """What encode gives for a text of these pieces; starts is what normalise gave, or None if no character was mapped."""
        first, last = struct.pack("<I", self.bos) if bos else b"", struct.pack("<I", self.eos) if eos else b""
        if not text:
            return first + last, bytes(len(first) + len(last))
        ids, sizes, chars = pieces
        if starts is None:
            ends = np.cumsum(sizes, dtype=np.int64)
            if self.dummy:
                ends -= 1
                np.maximum(ends, 0, out=ends)
                signs = text.count(SPACE)
                if signs:  # the sign itself is three bytes in the source, not one
                    ends = self._ends_with_signs(text, chars)
        else:
            ends = np.asarray(starts, np.int64)[np.cumsum(chars, dtype=np.int64)]
        spans = ends.astype("<u4").tobytes()
        # The last piece ends where the text does, or where trimming has cut it.
        total = spans[-4:] if not self.trim and spans else struct.pack("<I", len(text.encode("utf-8")))
        return first + ids.astype("<u4").tobytes() + last, bytes(len(first)) + spans + (total if eos else b"")

    def _ends_with_signs(self, text: str, chars: np.ndarray) -> np.ndarray:
        sizes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        width = 1 + (sizes > 0x7F) + (sizes > 0x7FF) + (sizes > 0xFFFF)
        offsets = np.concatenate([[0] * (1 + self.dummy), np.cumsum(width)])
        return offsets[np.cumsum(chars, dtype=np.int64)]

    def decode(self, packed: bytes) -> str:
        """The text of packed ids. Byte pieces that form no UTF-8 become U+FFFD each."""
        ids = np.frombuffer(packed, "<u4").tolist()
        surface, kinds = self.surface, self.kinds
        head = next((k for k, i in enumerate(ids) if kinds[i] != CONTROL), len(ids))
        out = b"".join(map(surface.__getitem__, ids[head:]))
        if self.dummy or self.trim:
            if head < len(ids) and kinds[ids[head]] == NORMAL and out.startswith(b" "):
                out = out.lstrip(b" ") if self.trim else out[1:]
        try:
            return out.decode("utf-8")
        except UnicodeDecodeError:
            return self._decode_parts(ids[head:])

    def _decode_parts(self, ids: list[int]) -> str:
        text, run, started = [], bytearray(), False

        def flush() -> None:
            data, at = bytes(run), 0
            while at < len(data):
                for size in (1, 2, 3, 4):
                    try:
                        text.append(data[at : at + size].decode("utf-8"))
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    text.append("�")
                    size = 1
                at += size
            run.clear()

        for i in ids:
            if self.kinds[i] == BYTE:
                run += self.surface[i]
                continue
            flush()
            piece = self.surface[i].decode("utf-8")
            if not started and not text and self.kinds[i] == NORMAL and (self.dummy or self.trim):
                if piece.startswith(" "):
                    piece = piece.lstrip(" ") if self.trim else piece[1:]
                    started = not self.trim
            text.append(piece) if piece else None
        flush()
        return "".join(text)


@lru_cache(maxsize=4)
def codec(path: str) -> SentencePieceCodec:
    """One codec for each model and Python worker."""
    return SentencePieceCodec(path)


#: Rows that go back to Spark at once: packed ids take more room than their text.
ROWS = 128

#: Characters of texts whose new units are learned together. Memory that is free after these goes back to the system: the JVM beside the worker may need it.
WINDOW = 2_000_000


def _windows(batch: pa.Array) -> Iterator[list[str]]:
    """The texts of a batch, "" for null, in lists of about WINDOW characters."""
    texts, chars = [], 0
    for t in batch:
        texts.append(t.as_py() or "")
        chars += len(texts[-1])
        if chars >= WINDOW:
            yield texts
            texts, chars = [], 0
    if texts:
        yield texts


def _coded(text: Column, path: str, bos: bool, eos: bool, decode: bool) -> Column:
    kind = pa.struct([("ids", pa.binary()), ("ends", pa.binary()), *[("decoded", pa.string())] * decode])

    @F.arrow_udf("ids binary, ends binary" + ", decoded string" * decode)
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made = codec(path)
        forget(made.unit_pieces)
        give_back()  # what tasks of other operators, with memos or without, have left free
        for coded in (made.encode_all(texts, bos, eos) for batch in batches for texts in _windows(batch)):
            while rows := list(islice(coded, ROWS)):
                columns = [pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)]
                if decode:
                    columns.append(pa.array([made.decode(ids) for ids, _ in rows], pa.string()))
                yield pa.StructArray.from_arrays(columns, fields=list(kind))
            release()

    return code(text)


def encoded(text: Column, path: str, bos: bool = True, eos: bool = True) -> Column:
    """struct(ids binary, ends binary) of a text column: packed ids and packed ends of their byte spans."""
    return _coded(text, path, bos, eos, False)


def round_trip(df: DataFrame, path: str, text: str = "text", into: str = "pieces") -> DataFrame:
    """encode_documents, with the text decoded from the ids as a third field, `decoded`, in the same pass. Nulls and all else as there."""
    return df.withColumn(into, _coded(F.coalesce(F.col(text), F.lit("")), path, True, True, True))


def decoded(ids: Column, path: str) -> Column:
    """The text of a column of packed ids."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made = codec(path)
        forget(made.unit_pieces)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                yield pa.array([made.decode(b.as_py()) if b.is_valid else None for b in batch.slice(at, ROWS)], pa.string())

    return decode(ids)


def encode_documents(df: DataFrame, path: str, text: str = "text", into: str = "pieces") -> DataFrame:
    """Add `into`, a struct of packed ids with begin and end ids, and packed ends of their byte spans.

    Nulls: a null text is encoded as the empty text, to the begin and end ids alone. Other columns
    pass through as they are; an existing column named `into` is replaced. Texts of any length are
    encoded whole, repeated rows each; an empty table stays empty.
    """
    return df.withColumn(into, encoded(F.coalesce(F.col(text), F.lit("")), path))


def decode_documents(df: DataFrame, path: str, ids: str, into: str = "decoded") -> DataFrame:
    """Add `into`, the text of the packed ids in column `ids`.

    Nulls: null ids give a null text, no ids the empty one. Other columns pass through; an existing column named `into` is replaced. Ids of
    any number are decoded whole, repeated rows each; an empty table stays empty.
    """
    return df.withColumn(into, decoded(F.col(ids), path))
