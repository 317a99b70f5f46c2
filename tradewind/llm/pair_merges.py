"""Byte-pair encoding by a pair occurrence index, and decoding.

A batch's texts are cut at blanks into pieces and the pieces into words; every distinct word that has not been met is
written once, as one long array of symbols. The index maps each mergeable pair, by its rank, to all positions where it
stands. Ranks are applied in ascending order, each at all its positions together; a merge changes only the pairs to its
left and right, whose new positions are appended to the lists of their ranks. A vocabulary whose rules only use what
rules of lower rank made (checked when it is loaded) never makes a pair of a rank that is over, so one ascending pass over
the active ranks gives what merging word by word would.

Normalising and cutting a piece into words is done by the components that the vocabulary file names. Only ASCII blanks
cut pieces, and neither a normaliser nor a word can reach across one, so a piece gives the same words in every text.

Defined results: a null or empty text has no tokens and decodes to an empty text; every byte has a symbol, so nothing is
unknown; strings of the file's special tokens become those tokens; decoding joins the tokens' strings by blanks, as a file
without a decoder asks, and leaves out ids that the vocabulary lacks; null ids decode to a null text; repeated rows and null
row ids are kept as they are; an empty table gives an empty result; other columns are left out unless asked for.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tradewind.llm.common import sliced, tidied

#: Characters of text taken together; a longer text stands alone.
CHUNK = 4_000_000
#: Words and pieces remembered between batches of a task before the memory starts anew.
REMEMBERED = 300_000
_BLANKS = re.compile("[\\x20\\x09-\\x0D]+")
#: The pattern below for ASCII pieces, each ended by a line break.
_PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9\n]+|\n")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = [""] * 256, 256
    for b in range(256):
        if b in own:
            letters[b] = chr(b)
        else:
            letters[b], spare = chr(spare), spare + 1
    return letters


class MergeModel:
    """A vocabulary file as arrays: the symbols of bytes, and the merge rules by the pair they join."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            declared = json.load(f)
        rules, vocabulary = declared["model"]["merges"], declared["model"]["vocab"]
        suffix = declared["model"].get("end_of_word_suffix") or ""
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if declared["model"].get(k)]
        if odd or declared["model"]["type"] != "BPE" or declared["decoder"] or declared["post_processor"]:
            raise ValueError(f"not a plain vocabulary of merges with word ends: {odd or 'model, decoder or post processor'}")
        tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = tokenizer.normalizer, tokenizer.pre_tokenizer
        cuts = (declared["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        kinds = [n["type"] for n in (declared["normalizer"] or {}).get("normalizers", [])]
        #: Pieces of ASCII letters are lower-cased and cut by a plain pattern when the file asks for just that.
        self.plain = kinds == ["NFC", "Replace", "Lowercase"] and cuts[0].get("pattern") == {"Regex": _PATTERN}
        special = {t["content"]: t["id"] for t in declared["added_tokens"]}
        self.special = re.compile("(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.special_ids = special
        letters = byte_letters()
        self.byte_of = {ord(c): b for b, c in enumerate(letters)}
        self.inner = np.array([vocabulary[c] for c in letters], np.int32)
        self.final = np.array([vocabulary[c + suffix] for c in letters], np.int32)
        self.size = max([*vocabulary.values(), *special.values()]) + 1
        strings: list[bytes | None] = [None] * self.size
        for token, i in [*vocabulary.items(), *special.items()]:
            strings[i] = token.encode()
        self.strings = strings
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in rules]
        self.left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        last_made = np.full(self.size, -1, np.int64)
        last_made[self.made] = np.arange(len(pairs))
        if (np.maximum(last_made[self.left], last_made[self.right]) >= np.arange(len(pairs))).any():
            raise ValueError("a rule uses a symbol that a later rule makes")
        codes = self.left * self.size + self.right
        self.by_code = np.argsort(codes, kind="stable")
        self.codes = codes[self.by_code]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where no rule joins it."""
        code = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.by_code[at], -1)

    def words(self, piece: str) -> list[str]:
        """The words of a piece without special tokens, one letter below U+0100 for each byte."""
        piece = self.normalizer.normalize_str(piece) if self.normalizer else piece
        return [w.translate(self.byte_of) for w, _ in self.pre_tokenizer.pre_tokenize_str(piece)]


def _disjoint(at: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of sorted places of a pair of equal symbols, those a merge from left to right takes: every second of a run."""
    joined = np.zeros(len(at), bool)
    joined[1:] = following[:-1] == at[1:]
    place = np.arange(len(at))
    begin = np.maximum.accumulate(np.where(joined, 0, place))
    return at[(place - begin) % 2 == 0]


def merge(words: list[bytes], model: MergeModel) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words in order, n + 1 bounds), by one ascending pass over the active ranks of the occurrence index."""
    width = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    n, ends = len(data), np.cumsum(width)
    symbol = np.append(model.inner[data], -1)
    symbol[ends[width > 0] - 1] = model.final[data[ends[width > 0] - 1]]
    # neighbours inside the word; n stands for none and holds no symbol
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    after[ends[width > 0] - 1] = n
    begins = ends[width > 0] - width[width > 0]
    before[begins] = n
    before = np.append(before, n)
    alive = np.ones(n, bool)
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def list_pairs(at: np.ndarray) -> None:
        """Append positions to the lists of their pairs' ranks."""
        rank = model.ranks(symbol[at], symbol[after[at]])
        known = rank >= 0
        rank, at = rank[known], at[known]
        if len(rank) == 0:
            return
        order = np.argsort(rank, kind="stable")
        rank, at = rank[order], at[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        firsts = rank[np.concatenate([[0], cuts])].tolist()
        bounds = [0, *cuts.tolist(), len(rank)]
        for r, a, b in zip(firsts, bounds, bounds[1:]):
            if r in index:
                index[r].append(at[a:b])
            else:
                index[r] = [at[a:b]]
                heapq.heappush(active, r)

    list_pairs(np.flatnonzero(after[:n] < n))
    while active:
        r = heapq.heappop(active)
        lists = index.pop(r)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        a, b = model.left[r], model.right[r]
        at = at[(symbol[at] == a) & (symbol[after[at]] == b) & alive[at]]  # others were merged away since they were listed
        if a == b and len(at):
            at = _disjoint(np.sort(at), after[np.sort(at)])
        if len(at) == 0:
            continue
        gone = after[at]
        symbol[at], alive[gone] = model.made[r], False
        after[at] = after[gone]
        before[after[at]] = at
        left = before[at]
        left = left[left < n]
        list_pairs(np.unique(np.concatenate([left, at[after[at] < n]])))
    where = np.flatnonzero(alive)
    return symbol[where], np.searchsorted(where, np.concatenate([[0], ends]))


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


def _gathered(flat: np.ndarray, bounds: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the chosen ranges of ``flat`` one after the other, their n + 1 bounds)."""
    begin, size = bounds[chosen], bounds[chosen + 1] - bounds[chosen]
    upto = np.concatenate([[0], np.cumsum(size)])
    return flat[np.arange(upto[-1]) - np.repeat(upto[:-1] - begin, size)], upto


class Encoder:
    """Encodes batches of texts; words and pieces met before are remembered, up to REMEMBERED of each.

    A word is known by a string of one letter for each byte, a special token by a tuple; number 0 is the line break that
    ends a piece. Ids of all words, and of all pieces, stand in one array each.
    """

    def __init__(self, model: MergeModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        special = self.model.special_ids
        self.words = _Numbers({"\n": 0, **{(t,): k for k, t in enumerate(special, 1)}})
        self.word_ids = np.array(list(special.values()), np.int32)
        self.word_bounds = np.concatenate([[0], np.arange(len(special) + 1)])
        self.pieces = _Numbers({"": 0})
        self.ids, self.bounds = np.zeros(0, np.int32), np.zeros(2, np.int64)

    def _cut(self, pieces: list[str]) -> Iterator[str | tuple[str]]:
        """The words of pieces one by one, a line break after each piece."""
        for piece in pieces:
            for k, part in enumerate(self.model.special.split(piece) if self.model.special else [piece]):
                if k % 2:
                    yield (part,)
                elif part:
                    yield from self.model.words(part)
            yield "\n"

    def _learn(self, fresh: list[str]) -> None:
        """Ids of pieces that have not been met, in the order of their numbers."""
        model, known = self.model, len(self.words)
        special = model.special if model.special and model.special.search("\n".join(fresh)) else None
        plain = np.array([model.plain and p.isascii() and not (special and special.search(p)) for p in fresh], bool)
        order = np.argsort(~plain, kind="stable")
        n = int(plain.sum())
        found = _PLAIN.findall("\n".join([fresh[i] for i in order[:n]] + [""] * (n > 0)).lower())
        found += self._cut([fresh[i] for i in order[n:]])
        number = np.fromiter(map(self.words.__getitem__, found), np.int64, len(found))
        ids, bounds = merge([w.encode("latin-1") for w in islice(self.words, known, None)], model)
        self.word_bounds = np.concatenate([self.word_bounds, self.word_bounds[-1] + bounds[1:]])
        self.word_ids = np.concatenate([self.word_ids, ids])
        ids, upto = _gathered(self.word_ids, self.word_bounds, number)
        ids, bounds = _gathered(ids, np.concatenate([[0], upto[:-1][number == 0]]), np.argsort(order))
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + bounds[1:]])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, n + 1 bounds)."""
        if len(self.pieces) > REMEMBERED or len(self.words) > REMEMBERED:
            self._forget()
        cut = [_BLANKS.split(t) if t else [] for t in texts]
        counts, known = np.array([len(c) for c in cut], np.int64), len(self.pieces)
        number = np.fromiter(map(self.pieces.__getitem__, chain.from_iterable(cut)), np.int64, int(counts.sum()))
        if len(self.pieces) > known:
            self._learn(list(islice(self.pieces, known, None)))
        ids, upto = _gathered(self.ids, self.bounds, number)
        return ids, upto[np.concatenate([[0], np.cumsum(counts)])]


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def encode(docs: DataFrame, vocabulary: str, keep: list[str | Column] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` with the columns ids (array of int) and ids_sha256 (of 32-bit little-endian ids). One pass, no shuffle.

    The vocabulary file is read on the driver; its arrays (about 4 MB) are broadcast once.
    """
    model = docs.sparkSession.sparkContext.broadcast(MergeModel(vocabulary))
    chosen = docs.select(*keep, F.col(text_col).alias("__text"))
    names = chosen.columns[:-1]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value)
        for batch in sliced(batches, 2500):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for a, b in _chunks(texts):
                ids, bounds = encoder.encode(texts[a:b])
                raw = memoryview(ids.astype("<u4")).cast("B")
                digests = [hashlib.sha256(raw[4 * i : 4 * j]).hexdigest() for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
                kept = [batch.column(k).slice(a, b - a) for k in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, lists, pa.array(digests, pa.string())], [*names, "ids", "ids_sha256"])

    fields = StructType(chosen.schema.fields[:-1]).add("ids", ArrayType(IntegerType())).add("ids_sha256", "string")
    return chosen.mapInArrow(tidied(code), fields)


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text its ids spell instead of the ids. One pass, no shuffle."""
    model = encoded.sparkSession.sparkContext.broadcast(MergeModel(vocabulary).strings)
    rest = [c for c in encoded.columns if c not in (ids_col, text_col)]
    chosen = encoded.select(*rest, ids_col)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = dict(enumerate(model.value))
        for batch in sliced(batches, 1000):
            texts = []
            for ids in batch.column(batch.num_columns - 1):
                if not ids.is_valid:
                    texts.append(None)
                    continue
                found = map(strings.get, ids.values.to_numpy(zero_copy_only=False).tolist())
                texts.append(b" ".join([s for s in found if s is not None]).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*rest, text_col])

    return chosen.mapInArrow(tidied(spell), StructType([*chosen.schema.fields[:-1], StructField(text_col, StringType())]))
