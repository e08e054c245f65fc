"""BPE encoding and decoding by a pair occurrence index.

The distinct pieces of a partition's texts are laid into one symbol list. An index maps each adjacent pair to all its
positions; a heap holds the ranks of the pairs present. The lowest rank is applied at all positions of its pair at once,
each merge unlinks two neighbours and lists the new ones, until no pair with a rank is left. Pieces never touch, so this
equals merging each piece alone; equal positions go left to right. Pieces already seen in the worker are remembered up
to a bound, which only saves time.

Texts of any length are encoded whole; null is empty; empty and blank texts have no ids. Repeated rows are encoded alike.
Strings of special tokens in a text become their ids, as in the public library. Extra columns stay; a column named
like a result is replaced by it.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.llm.common import give_back

# An entry takes some 400 bytes, so each table of a worker stays under 20 MB.
_REMEMBERED, _LONGEST_REMEMBERED = 40_000, 64
_SLICE_CHARS = 1_000_000
_ID_BITS = 20


# White space of the Unicode standard. Fixed values.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Letters and digits of Unicode 16, which the public library knows and Python's tables do not yet. Fixed values.
_NEW_LETTERS = ((0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
                (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
                (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0))
_NEW_DIGITS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))


@functools.cache
def class_ranges(kind: str) -> str:
    """Code points of a general category (L or N) as ranges of a character class."""
    points = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == kind]
    points += [c for a, b in (_NEW_LETTERS if kind == "L" else _NEW_DIGITS) for c in range(a, b + 1)]
    points = np.unique(points)
    cuts = np.flatnonzero(np.diff(points) > 1)
    pairs = zip(points[np.concatenate([[0], cuts + 1])].tolist(), points[np.append(cuts, len(points) - 1)].tolist())
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in pairs)


def byte_letters() -> list[str]:
    """The printable letter of each byte value: printable Latin-1 stands for itself, the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = [], 256
    for b in range(256):
        if b in plain:
            letters.append(chr(b))
        else:
            letters.append(chr(extra))
            extra += 1
    return letters


class PairIndexBpe:
    """A word-end BPE vocabulary file of the public tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model["unk_token"] or model["byte_fallback"] or model["continuing_subword_prefix"]:
            raise ValueError("only BPE files with bytes as letters and word ends are read")
        if spec["decoder"] or spec["post_processor"]:
            raise ValueError("files with a decoder or post-processor are not read")
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        # A pair of ids is one number; its rank leads to both ids and to the id of the merged token.
        self.rank_of: dict[int, int] = {}
        self.first, self.second, self.into = [], [], []
        for pair in model["merges"]:
            left, right = (self.vocab[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.rank_of.setdefault(left << _ID_BITS | right, len(self.into))
            self.first.append(left)
            self.second.append(right)
            self.into.append(self.vocab[self.tokens[left] + self.tokens[right]])
        letters = byte_letters()
        self.inner = np.array([self.vocab[x] for x in letters])
        self.last = np.array([self.vocab[x + self.suffix] for x in letters])
        self.pair_keys = np.array(sorted(self.rank_of))
        self.pair_ranks = np.array([self.rank_of[k] for k in self.pair_keys.tolist()])
        self.names = {i: str(i) for i in self.tokens}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        rule = split["pattern"]["Regex"].replace(r"\p{L}", class_ranges("L")).replace(r"\p{N}", class_ranges("N")).replace(r"\s", _SPACE)
        self.pieces = re.compile(rule)
        self.marks = re.compile("|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.odd_space = re.compile("[\x1c-\x1f]")
        self.spaces = re.compile(f"[{_SPACE}]+")
        self.forget()

    def forget(self) -> None:
        """Drop remembered pieces and chunks: id text and decoded text of each."""
        self.pieces_known: dict[str, tuple[str, str]] = {}
        self.chunks_known: dict[str, tuple[str, str]] = {}

    def merge(self, pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after another, where each piece's begin and the last ends), from one pair index over all of them."""
        sizes = np.array([len(p) for p in pieces])
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum(sizes)
        symbol = self.inner[data]
        symbol[ends - 1] = self.last[data[ends - 1]]
        right, left = np.arange(1, len(data) + 1), np.arange(-1, len(data) - 1)
        right[ends - 1] = -1
        left[ends - sizes] = -1
        where: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def listed(at: np.ndarray, pairs: np.ndarray) -> None:
            """Put the positions of pairs that have a rank into the index."""
            place = np.minimum(np.searchsorted(self.pair_keys, pairs), len(self.pair_keys) - 1)
            known = self.pair_keys[place] == pairs
            ranks, at = self.pair_ranks[place[known]], at[known]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], at[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(at)]
            for rank, a, b in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:]):
                if rank in where:
                    where[rank].append(at[a:b])
                else:
                    where[rank] = [at[a:b]]
                    heapq.heappush(heap, rank)

        at = np.flatnonzero(right >= 0)
        listed(at, symbol[at] << _ID_BITS | symbol[at + 1])
        while heap:
            rank = heapq.heappop(heap)
            first, second, into = self.first[rank], self.second[rank], self.into[rank]
            own = where.pop(rank)
            i = own[0] if len(own) == 1 else np.concatenate(own)
            if first == second:  # only where two merged neighbours meet is a position listed twice, and only here does the order count
                i = np.unique(i)
            j = right[i]
            holds = (symbol[i] == first) & (j >= 0) & (symbol[j] == second)  # else an earlier merge took one of the two
            i, j = i[holds], j[holds]
            if first == second and len(i) > 1:
                i, j = self._left_pairs_of_runs(i, j)
            if not len(i):
                continue
            symbol[i], symbol[j] = into, -1
            k = right[i] = right[j]
            left[k[k >= 0]] = i[k >= 0]
            h = left[i]
            before, after = h >= 0, k >= 0
            listed(np.concatenate([h[before], i[after]]),
                   np.concatenate([symbol[h[before]] << _ID_BITS | into, into << _ID_BITS | symbol[k[after]]]))
        kept = symbol >= 0
        return symbol[kept], np.concatenate([[0], np.cumsum(kept)[ends - 1]])

    @staticmethod
    def _left_pairs_of_runs(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """In a run of equal symbols every second pair merges, from the left."""
        follows = np.concatenate([[False], i[1:] == j[:-1]])
        heads = np.maximum.accumulate(np.where(follows, 0, np.arange(len(i))))
        even = (np.arange(len(i)) - heads) % 2 == 0
        return i[even], j[even]

    def learn(self, chunks: set[str]) -> dict[str, tuple[str, str]]:
        """(id text, decoded text) of chunks, which hold no white space."""
        words, others = {}, {}
        for chunk in chunks:
            plain = chunk.lower() if chunk.isascii() else unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
            if plain.isalpha():
                words[chunk] = plain
            else:
                others[chunk] = self.pieces.findall(plain)
        known = self.pieces_known
        seen = set(words.values()).union(*others.values())
        if len(known) + len(seen) > _REMEMBERED:
            known = self.pieces_known = {p: known[p] for p in seen if p in known}
        new = list(seen.difference(known))
        if new:
            ids, cuts = self.merge([p.encode("utf-8", "surrogatepass") for p in new])
            ids, cuts = ids.tolist(), cuts.tolist()
            numbers, texts = list(map(self.names.__getitem__, ids)), list(map(self.tokens.__getitem__, ids))
            for piece, a, b in zip(new, cuts, cuts[1:]):
                known[piece] = (" ".join(numbers[a:b]), " ".join(texts[a:b]))
        out = dict(zip(words, map(known.__getitem__, words.values())))
        for chunk, ps in others.items():
            found = [known[p] for p in ps]
            out[chunk] = (" ".join([x[0] for x in found]), " ".join([x[1] for x in found]))
        for long in [p for p in new if len(p) > _LONGEST_REMEMBERED]:
            del known[long]
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """Tokens joined by a space, special ones too, as a file without a decoder says."""
        return " ".join(self.tokens[i] for i in ids)

    def chunks(self, text: str) -> list[str]:
        """White-space-free parts; special strings are parts of their own. Merges never cross white space."""
        if self.odd_space.search(text):
            return [c for part in self._marked(text) for c in ([part] if part in self.special else self.spaces.split(part)) if c]
        if "<|" in text:
            return [c for part in self._marked(text) for c in ([part] if part in self.special else part.split())]
        return text.split()

    def _marked(self, text: str) -> list[str]:
        out, at = [], 0
        for m in self.marks.finditer(text):
            out += [text[at : m.start()], m.group()]
            at = m.end()
        return [*out, text[at:]]

    def encode(self, texts: Sequence[str | None]) -> Iterator[tuple[int, str, str]]:
        """(number of ids, ids joined by spaces, decoded text) of each text."""
        for first, size in runs([len(t) if isinstance(t, str) else 0 for t in texts]):
            run = [t if isinstance(t, str) else "" for t in texts[first : first + size]]
            split = [self.chunks(t) for t in run]
            seen = set().union(*split)
            known = self.chunks_known
            here = {c: known[c] for c in seen.intersection(known)}
            here.update((t, (str(i), t)) for t, i in self.special.items())
            here.update(self.learn(seen.difference(here)))
            # Chunks of the last run stay known up to the bound, those first that were known before: frequent ones are learned once. Long ones are not kept.
            self.chunks_known = dict(islice(((c, x) for c, x in here.items() if len(c) <= _LONGEST_REMEMBERED), _REMEMBERED))
            get = here.__getitem__
            for chunks in split:
                found = list(map(get, chunks))
                ids = " ".join([x[0] for x in found])
                yield ids.count(" ") + 1 if ids else 0, ids, " ".join([x[1] for x in found])


def runs(sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    """(first, count) of neighbours that sum to about _SLICE_CHARS, or of one that is larger."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if i > first and total + size > _SLICE_CHARS:
            yield first, i - first
            first, total = i, 0
        total += size
    if len(sizes) > first:
        yield first, len(sizes) - first


_loaded: dict[str, PairIndexBpe] = {}


def loaded(path: str) -> PairIndexBpe:
    """One vocabulary per worker process, until its task ends."""
    if path not in _loaded:
        _loaded[path] = PairIndexBpe(path)
    return _loaded[path]


def unload() -> None:
    """Keep nothing in a worker, which is used again by other stages."""
    _loaded.clear()
    give_back()


_RESULTS = {"ids": T.ArrayType(T.IntegerType()), **dict.fromkeys(("ids_text", "decoded", "ids_sha256", "decoded_sha256"), T.StringType())}


def encode_decode(df: DataFrame, vocabulary: str, text: str = "text", results: Sequence[str] = ("ids", "ids_text", "decoded")) -> DataFrame:
    """Add n_tokens long and the named results. ``vocabulary`` is a path every executor has.

    ``ids`` are the token ids, ``ids_text`` the same joined by spaces, ``decoded`` the text read back; ``ids_sha256`` and
    ``decoded_sha256`` are the lower-case hex digests of the latter two, made in the worker so that the texts need not leave it.
    """
    new = T.StructType().add("n_tokens", "long")
    for name in results:
        new = new.add(name, _RESULTS[name])
    kept = [c for c in df.columns if c not in ("n_tokens", *_RESULTS)]
    make = {"ids": lambda ids, _: np.fromstring(ids, np.int32, sep=" ") if ids else np.zeros(0, np.int32), "ids_text": lambda ids, _: ids,
            "decoded": lambda _, decoded: decoded, "ids_sha256": lambda ids, _: hashlib.sha256(ids.encode()).hexdigest(),
            "decoded_sha256": lambda _, decoded: hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest()}
    kinds = {"ids": pa.list_(pa.int32())}

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        # Nothing here refers to itself; looking for such rings through all remembered pieces took an eighth of the time.
        gc.disable()
        try:
            yield from parts(bpe, batches)
        finally:
            gc.enable()
            del bpe
            unload()

    def parts(bpe: PairIndexBpe, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_pylist()
            for first, size in runs(sizes):
                part = batch.slice(first, size)
                counts, found = [], [[] for _ in results]
                for n, ids, decoded in bpe.encode(part.column(part.num_columns - 1).to_pylist()):
                    counts.append(n)
                    for name, values in zip(results, found):
                        values.append(make[name](ids, decoded))
                arrays = [pa.array(values, kinds.get(name, pa.string())) for name, values in zip(results, found)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(counts, pa.int64()), *arrays], names=[*part.schema.names[:-1], *new.names])

    schema = T.StructType([*(df.schema[c] for c in kept), *new])
    return df.select(*kept, F.col(text).alias("__text")).mapInArrow(encoded, schema)
