"""SentencePiece BPE: texts to ids by vectorised merge rounds, and ids back to texts.

The distinct words of a slice of texts lie in one flat array of symbols. In every round each
word finds its best pair (a segmented minimum over ranks) and merges its occurrences from the
left; merged symbols are squeezed out, words without a pair leave, and the rounds end when
no pair remains. The ids are those of the library: there, one merge at a time is made, the best
pair first and the leftmost of equals. Merging several occurrences in a round is the same as long
as none of them makes a pair that is as good or better; a word's merges after such a one wait for
the next round.

Words end where no piece of the vocabulary holds both neighbouring characters, so no merge
crosses them. Nulls are empty texts and give the begin and end ids only. Characters outside the
vocabulary become their UTF-8 bytes. Texts are encoded whole: long ones are a slice of their
own, with memory in proportion to the text. Repeated rows give repeated rows, further columns are
carried along unless named like one of the results, and an empty table gives an empty one.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import slices, texts_of

#: The sign that stands for a space, and the place of an unreadable byte.
SPACE, UNREADABLE = "▁", "�"
NONE = np.int32(2**31 - 1)
_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_MIX = np.uint64(0x9E3779B97F4A7C15)

codecs.register_error("tidemark_each_byte", lambda e: (UNREADABLE * (e.end - e.start), e.end))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pairs:
    """A table from two neighbouring pieces to the rank and id of what they merge to."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray, pieces: int):
        self.pieces = pieces
        bits = max(4, int(2 * len(left)).bit_length() + 1)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank, self.merged = np.full(1 << bits, NONE, np.int32), np.full(1 << bits, -1, np.int32)
        keys = left.astype(np.int64) * pieces + right
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.rank[slot[put]], self.merged[slot[put]] = keys[put], rank[put], merged[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of each pair; ``NONE`` and -1 for pairs that don't merge."""
        keys = left.astype(np.int64) * self.pieces + right
        slot = self._slot(keys)
        there = self.keys[slot]
        lost = np.flatnonzero((there != keys) & (there >= 0))
        while len(lost):
            slot[lost] = (slot[lost] + 1) & self.mask
            there = self.keys[slot[lost]]
            lost = lost[(there != keys[lost]) & (there >= 0)]
        found = self.keys[slot] == keys
        return np.where(found, self.rank[slot], NONE), np.where(found, self.merged[slot], np.int32(-1))


class Model:
    """Pieces, scores and spaces of a SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec, kind = proto.normalizer_spec, pb.ModelProto.SentencePiece
        kinds = {p.type for p in proto.pieces}
        if (proto.trainer_spec.model_type != pb.TrainerSpec.BPE or not proto.trainer_spec.byte_fallback
                or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces
                or proto.trainer_spec.treat_whitespace_as_suffix or proto.denormalizer_spec.precompiled_charsmap
                or kinds - {kind.NORMAL, kind.UNKNOWN, kind.CONTROL, kind.BYTE}):
            raise ValueError("only BPE models with byte fallback and texts as they are can be read")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.begin, self.end, self.unknown = (proto.trainer_spec.bos_id, proto.trainer_spec.eos_id,
                                              proto.trainer_spec.unk_id)
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kind.NORMAL}
        self.byte_ids = np.zeros(256, np.int32)
        #: What each id stands for in a decoded text, in UTF-8.
        self.surface: list[bytes] = []
        for i, p in enumerate(proto.pieces):
            if p.type == kind.BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
                self.surface.append(bytes([int(p.piece[1:-1], 16)]))
            elif p.type == kind.UNKNOWN:
                self.surface.append(proto.trainer_spec.unk_surface.encode())
            else:
                self.surface.append(b"" if p.type == kind.CONTROL else p.piece.replace(SPACE, " ").encode())
        self.silent = {i for i, p in enumerate(proto.pieces) if p.type == kind.CONTROL}
        self.plain = frozenset(normal.values())

        scores = sorted({proto.pieces[i].score for i in normal.values()}, reverse=True)
        place = {s: r for r, s in enumerate(scores)}
        found = [(normal[p[:k]], normal[p[k:]], place[proto.pieces[i].score], i)
                 for p, i in normal.items() for k in range(1, len(p)) if p[:k] in normal and p[k:] in normal]
        self.pairs = Pairs(*np.array(found, np.int32).reshape(-1, 4).T, len(proto.pieces))
        letters = sorted({c for p in normal for c in p})
        number = {c: n + 1 for n, c in enumerate(letters)}
        #: Numbers of the characters that pieces hold (0: none does), and ids of those that are pieces (-1: none).
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.single = np.full(0x110000, -1, np.int32)
        for c in letters:
            self.single[ord(c)] = normal.get(c, -1)
        #: Whether a piece holds the two characters side by side.
        self.joined = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for p in normal:
            for a, b in zip(p, p[1:]):
                self.joined[number[a], number[b]] = True

    def segments(self, text: str) -> list[str]:
        """Runs of spaces with the characters up to the next space."""
        return _SEGMENT.findall(self.prefix + text.replace(" ", SPACE)) if text else []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, without begin and end, and where each text ends."""
        index: dict[str, int] = {}
        put = index.setdefault
        parts = [np.array([put(s, len(index)) for s in self.segments(t)], np.int64) for t in texts]
        ids, ends = self.merged(list(index))
        sizes, starts = np.diff(ends, prepend=0), ends - np.diff(ends, prepend=0)
        where = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        counts = sizes[where] if len(where) else where
        after = np.cumsum(counts)
        take = np.repeat(starts[where] - (after - counts), counts) + np.arange(after[-1] if len(after) else 0)
        text_ends = np.concatenate([[0], after])[np.cumsum([len(p) for p in parts], dtype=np.int64)] if parts \
            else np.zeros(0, np.int64)
        return ids[take] if len(take) else np.zeros(0, np.int32), text_ends

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and where each of them ends."""
        lengths = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        number, out = self.letter[points], self.single[points]
        cut = np.zeros(len(points), bool)
        cut[np.cumsum(lengths)[:-1]] = True
        cut[1:] |= ~self.joined[number[:-1], number[1:]]
        known = out >= 0
        cut[1:] |= ~(known[1:] & known[:-1])
        alive = np.ones(len(points), bool)
        self._rounds(out, alive, np.cumsum(cut, dtype=np.int32))

        # Characters without an id give a byte each.
        bare = alive & (out < 0)
        width = alive.astype(np.int64)
        width[bare] = 1 + (points[bare] >= 0x80) + (points[bare] >= 0x800) + (points[bare] >= 0x10000)
        after = np.cumsum(width)
        ids = np.empty(after[-1], np.int32)
        ids[(after - width)[alive & ~bare]] = out[alive & ~bare]
        if bare.any():
            data = points[bare].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
            first, n = (after - width)[bare], width[bare]
            spots = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            ids[spots] = self.byte_ids[np.frombuffer(data, np.uint8)]
        return ids, np.concatenate([[0], after])[np.cumsum(lengths)]

    def _rounds(self, out: np.ndarray, alive: np.ndarray, word: np.ndarray) -> None:
        """Merge in place: ``out`` holds the ids at the places that stay ``alive``."""
        spot = np.arange(len(out))
        sym = out.copy()
        rank, result = self._neighbours(sym, word, np.arange(len(sym)))
        while True:
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            low = np.minimum.reduceat(rank, starts)
            if not (low < NONE).any():
                return
            sizes = np.diff(starts, append=len(word))
            low = np.repeat(low, sizes)
            if (low == NONE).any():
                stay = low < NONE
                sym, word, spot, rank, result, low = (x[stay] for x in (sym, word, spot, rank, result, low))
            # Overlapping occurrences follow each other: every second of such a run merges.
            at = np.flatnonzero(rank == low)
            run = np.diff(at, prepend=-2) != 1
            nth = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[nth % 2 == 0]
            at = at[self._orderly(sym, word, rank, result, at)]

            sym[at] = result[at]
            out[spot[at]] = sym[at]
            alive[spot[at + 1]] = False
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            sym, word, spot, rank, result = (x[stay] for x in (sym, word, spot, rank, result))
            at = at - np.arange(len(at))
            changed = np.zeros(len(sym), bool)
            changed[at] = True
            changed[at[at > 0] - 1] = True
            near = np.flatnonzero(changed)
            rank[near], result[near] = self._neighbours(sym, word, near)
            if not len(sym):
                return

    def _neighbours(self, sym: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of the pairs that begin at the given places."""
        rank, result = np.full(len(at), NONE, np.int32), np.full(len(at), -1, np.int32)
        inner = at < len(sym) - 1
        inner[inner] = word[at[inner]] == word[at[inner] + 1]
        if inner.any():
            rank[inner], result[inner] = self.pairs.find(sym[at[inner]], sym[at[inner] + 1])
        return rank, result

    def _orderly(self, sym, word, rank, result, at) -> np.ndarray:
        """Which merges come up before any pair as good or better that they make in their word."""
        new, best = result[at], rank[at]
        worse = np.zeros(len(at), bool)
        after = np.minimum(at + 2, len(sym) - 1)
        some = (at + 2 < len(sym)) & (word[after] == word[at])
        if some.any():
            worse[some] = self.pairs.find(new[some], sym[after[some]])[0] <= best[some]
        before = np.maximum(at - 1, 0)
        left = sym[before]
        follows = np.flatnonzero(np.diff(at, prepend=-9) == 2)
        left[follows] = new[follows - 1]
        some = (at > 0) & (word[before] == word[at])
        if some.any():
            worse[some] |= self.pairs.find(left[some], new[some])[0] <= best[some]
        if not worse.any():
            return np.ones(len(at), bool)
        earlier = np.cumsum(worse) - worse
        first = np.flatnonzero(np.diff(word[at], prepend=-1))
        base = np.repeat(earlier[first], np.diff(first, append=len(at)))
        return earlier == base

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; bytes that are no UTF-8 become U+FFFD each."""
        surface, texts, at = self.surface, [], 0
        # Bytes on both sides of a control id are no character together.
        for stop in [n for n, i in enumerate(ids) if i in self.silent] + [len(ids)]:
            if stop > at:
                data = b"".join([surface[i] for i in ids[at:stop]])
                if self.prefix and not texts and ids[at] in self.plain and data.startswith(b" "):
                    data = data[1:]
                texts.append(data.decode("utf-8", "tidemark_each_byte"))
            at = stop + 1
        return "".join(texts)


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def with_ends(model: Model, ids: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """The ids of each text between the begin and the end id, as unsigned 32-bit integers."""
    at = 0
    for end in ends:
        yield np.concatenate([[model.begin], ids[at:end], [model.end]]).astype("<u4")
        at = end


def encode_texts(df: DataFrame, path: str, column: str = "text") -> DataFrame:
    """Add ``ids``: the ids of each text, begin and end included.

    ``path`` names the vocabulary where the executors find it.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in slices(batches, column):
            ids, ends = model.encode(texts_of(batch, column))
            whole = ends + 2 * np.arange(1, len(ends) + 1)
            flat = np.concatenate(list(with_ends(model, ids, ends))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], whole]), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], lists], names=[*names, "ids"])

    names = [c for c in df.columns if c != "ids"]
    schema = T.StructType([f for f in df.schema.fields if f.name != "ids"] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return df.select(*names).mapInArrow(encode, schema)


def decode_ids(df: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """Add ``decoded``: the text of the ids; null for a null, and null ids stand for nothing."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            texts = [None if x is None else model.decode([i for i in x if i is not None])
                     for x in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(texts, pa.string())],
                                             names=[*names, "decoded"])

    names = [c for c in df.columns if c != "decoded"]
    schema = T.StructType([f for f in df.schema.fields if f.name != "decoded"] + [T.StructField("decoded", T.StringType())])
    return df.select(*names).mapInArrow(decode, schema)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Per document the number and digest of its ids, and the digest of the text they decode to.

    Encoding and decoding share a task, so ids never leave it.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in slices(batches, column):
            counts, encoded, decoded = [], [], []
            for ids in with_ends(model, *model.encode(texts_of(batch, column))):
                counts.append(len(ids))
                encoded.append(hashlib.sha256(ids.tobytes()).hexdigest())
                decoded.append(hashlib.sha256(model.decode(ids.tolist()).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = T.StructType([docs.schema[key], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return docs.select(key, column).mapInArrow(digest, schema)
