"""A SentencePiece vocabulary as arrays: hashed pieces, log-probabilities, and the pieces' bytes.

Text is written as pieces write it: one blank in front, blanks as U+2581. Bytes that no piece covers, and a literal
U+2581, are spelled by byte pieces, so that decoding gives back every text exactly.
"""

from __future__ import annotations

import re

import numpy as np

from tradewind.llm.common import powers, prefix_hashes

META = "▁".encode()
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
#: Byte pieces and unscored pieces rank behind all others.
_BYTE_PENALTY = 4.0
_REACH_BITS = 18


def beginnings(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` bytes from each place on; places too near the end have that of fewer bytes."""
    packed = np.zeros(len(data), np.uint64)
    for k in range(min(width, len(data))):
        packed[: len(data) - k] |= data[k:].astype(np.uint64) << np.uint64(8 * k)
    return (packed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _REACH_BITS)


class PieceModel:
    """``probability`` of the piece of rank r is proportional to 1 / (r + 3); merge ranks are what the file's scores tell."""

    def __init__(self, path: str):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        size = processor.get_piece_size()
        names = [processor.id_to_piece(i) for i in range(size)]
        scores = np.array([processor.get_score(i) for i in range(size)])
        self.bytes_of: list[bytes] = []
        self.byte_ids = np.full(256, -1, np.int64)
        usable = np.zeros(size, bool)
        for i, name in enumerate(names):
            if match := _BYTE.fullmatch(name):
                self.byte_ids[int(match[1], 16)] = i
                self.bytes_of.append(bytes([int(match[1], 16)]))
            elif processor.is_control(i) or processor.is_unknown(i):
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(name.replace("▁", " ").encode())
                usable[i] = True
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary has no full set of byte pieces")
        rank = np.where(scores > -1e8, -scores, size)
        weight = 1.0 / (rank + 3.0)
        weight[self.byte_ids] = np.exp(-_BYTE_PENALTY) / (size + 3.0)
        self.probability = weight / weight[usable | np.isin(np.arange(size), self.byte_ids)].sum()
        ids = np.flatnonzero(usable)
        encoded = [names[i].encode() for i in ids]
        self.lengths = np.array(sorted({len(e) for e in encoded}), np.int64)
        flat = np.frombuffer(b"".join(encoded), np.uint8)
        ends = np.cumsum([len(e) for e in encoded])
        begins = np.concatenate([[0], ends[:-1]])
        sums = prefix_hashes(flat)
        hashes = (sums[ends] - sums[begins]) * powers(len(sums))[1][begins]
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], ids[order].astype(np.int32)
        # the longest piece by a hash of its first four bytes, and by one of its first six
        self.reach = {width: np.zeros(1 << _REACH_BITS, np.uint8) for width in (4, 6)}
        for e in encoded:
            for width, table in self.reach.items():
                if len(e) >= width:
                    slot = beginnings(np.frombuffer(e, np.uint8), width)[0]
                    table[slot] = max(table[slot], len(e))
        # the place of a hash by its low bits: -1 for none, -2 where several share them
        slot = self._slots(self.hashes)
        self.place = np.full(1 << 20, -1, np.int32)
        self.place[slot] = np.arange(len(slot))
        several = np.bincount(slot, minlength=len(self.place)) > 1
        self.place[several] = -2

    def find(self, sums: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(which of the strings of ``size`` bytes from ``starts`` on are pieces, their ids), by sums of prefix_hashes"""
        hashes = (sums[starts + size] - sums[starts]) * powers(len(sums))[1][starts]
        at = self.place[self._slots(hashes)]
        maybe = np.flatnonzero(at != -1)
        at, hashes = at[maybe], hashes[maybe]
        shared = np.flatnonzero(at == -2)
        at[shared] = np.minimum(np.searchsorted(self.hashes, hashes[shared]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes
        return maybe[hit], self.ids[at[hit]]

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64((1 << 20) - 1)).astype(np.int64)

    def longest(self, data: np.ndarray) -> np.ndarray:
        """No piece that begins at a place is longer than this."""
        four, six = (self.reach[w][beginnings(data, w)] for w in (4, 6))
        return np.maximum(np.maximum(np.minimum(four, 5), six), 3)

    def decode(self, ids) -> str:
        raw = b"".join([self.bytes_of[i] for i in ids])
        return raw[1:].decode()  # without the blank in front
