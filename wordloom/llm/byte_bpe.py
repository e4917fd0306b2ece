"""Byte-level byte-pair encoding of many texts at once, on ragged numpy arrays.

A batch of texts is one array of code points. Array comparisons cut it into pre-tokens,
equal pre-tokens are kept once, and all of them are merged together: in every round each
pre-token joins its own pair of lowest rank, at every place where that pair stands. The
arrays shrink until no pre-token has a pair left. Ids and counts are those of the
``tokenizers`` library for the same file.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import regex

_LETTER, _NUMBER, _SPACE, _OTHER, _EDGE = 1, 2, 3, 4, 5
_NO_RANK = np.iinfo(np.int32).max
# The contractions that the pre-tokenizer of this vocabulary splits off.
_CONTRACTIONS = ("'s", "'t", "'m", "'d", "'re", "'ve", "'ll")
_WIDTHS = (4, 6, 8, 10, 12, 16, 24)  # of the matrices of short pre-tokens
_REMEMBERED = 400_000  # pre-tokens; some 20 MB
_LOW_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point: letter, number, white space or another."""
    table = np.full(0x110000, _OTHER, dtype=np.uint8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    everything = "".join(map(chr, points))
    for pattern, kind in ((r"\p{L}", _LETTER), (r"\p{N}", _NUMBER), (r"\p{White_Space}", _SPACE)):
        table[[ord(c) for c in regex.findall(pattern, everything)]] = kind
    return table


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable ones themselves."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in printable else spare))
        spare += byte not in printable
    return letters


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``start, start + 1, ...`` of every piece, one piece after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class ByteBpe:
    """The vocabulary of one ``tokenizers`` file of byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        self.specials = {
            token["content"]: token["id"] for token in content["added_tokens"]
        }
        self._special = (
            regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))))
            if self.specials
            else None
        )
        self._byte_ids = np.array([vocabulary[c] for c in _byte_letters()], dtype=np.int32)
        keys, merged = [], []
        for pair in content["model"]["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            keys.append((vocabulary[left] << 32) | vocabulary[right])
            merged.append(vocabulary[left + right])
        keys = np.array(keys, dtype=np.int64)
        self._merged = np.array(merged, dtype=np.int32)
        # An open-addressing table from pairs to ranks: a look-up is a few array reads.
        self._bits = int(np.ceil(np.log2(len(keys)))) + 3
        size = 1 << self._bits
        self._forget()
        self._slot_key = np.full(size, -1, dtype=np.int64)
        self._slot_rank = np.full(size, _NO_RANK, dtype=np.int32)
        self._probes = 0
        left = np.arange(len(keys))
        step = 0
        while len(left):
            at = (self._slot(keys[left]) + step) & (size - 1)
            free = self._slot_key[at] == -1
            first = np.zeros(len(left), dtype=bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self._slot_key[at[put]] = keys[left[put]]
            self._slot_rank[at[put]] = left[put]
            left = left[~put]
            step += 1
        self._probes = step

    def _forget(self) -> None:
        """Empties the memory of pre-tokens met before, sorted by their mixed word."""
        none = np.zeros(0, dtype=np.uint64)
        self._known = [none, none, none, none.astype(np.int64), none.astype(np.int64)]
        self._known_ids = none.astype(np.int32)

    def _remembered(self, mix, low, high, length, merge):
        """Begin in ``_known_ids`` and number of ids of distinct pre-tokens with increasing
        ``mix``; ``merge`` gives ids and numbers of those not met before."""
        if len(self._known[0]) > _REMEMBERED:
            self._forget()
        known, known_low, known_high, known_begin, known_count = self._known
        at = np.searchsorted(known, mix)
        hit = np.zeros(len(mix), dtype=bool)
        near = np.flatnonzero(at < len(known))
        spot = at[near]
        hit[near] = (known[spot] == mix[near]) & (known_low[spot] == low[near]) & (
            known_high[spot] == high[near]
        )
        begin, count = np.empty((2, len(mix)), dtype=np.int64)
        begin[hit], count[hit] = known_begin[at[hit]], known_count[at[hit]]
        new = np.flatnonzero(~hit)
        if len(new):
            ids, count[new] = merge(new)
            begin[new] = len(self._known_ids) + np.cumsum(count[new]) - count[new]
            self._known_ids = np.concatenate([self._known_ids, ids])
            # One that only differs from a known pre-token with its mixed word stays out.
            new = new[(at[new] == len(known)) | (np.append(known, 0)[at[new]] != mix[new])]
            added = (mix[new], low[new], high[new], begin[new], count[new])
            self._known = [np.insert(a, at[new], b) for a, b in zip(self._known, added)]
        return begin, count

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self._bits)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right
        at = self._slot(keys)
        found = self._slot_key[at]
        ranks = np.where(found == keys, self._slot_rank[at], _NO_RANK)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        for step in range(1, self._probes):
            if not len(open_):
                break
            at_open = (at[open_] + step) & (len(self._slot_key) - 1)
            found = self._slot_key[at_open]
            same = found == keys[open_]
            ranks[open_[same]] = self._slot_rank[at_open[same]]
            open_ = open_[~same & (found != -1)]
        return ranks

    def _segments(self, texts: list[str]):
        """Texts cut at special tokens: the pieces, the text of each, and for each the id
        of the special token that ends it (-1: none)."""
        if self._special is None or not any(s in t for t in texts for s in self.specials):
            return texts, np.arange(len(texts)), np.full(len(texts), -1, dtype=np.int32)
        pieces, owner, ending = [], [], []
        for number, text in enumerate(texts):
            last = 0
            for found in self._special.finditer(text):
                pieces.append(text[last : found.start()])
                owner.append(number)
                ending.append(self.specials[found.group()])
                last = found.end()
            pieces.append(text[last:])
            owner.append(number)
            ending.append(-1)
        return pieces, np.array(owner), np.array(ending, dtype=np.int32)

    @staticmethod
    def _starts(points: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where pre-tokens begin. ``edges`` are the first positions of the pieces."""
        n = len(points)
        kind = _classes()[points]
        before = np.empty(n, dtype=np.uint8)
        before[0] = _EDGE
        before[1:] = kind[:-1]
        before[edges] = _EDGE
        after = np.empty(n, dtype=np.uint8)
        after[-1] = _EDGE
        after[:-1] = kind[1:]
        after[edges[edges > 0] - 1] = _EDGE
        is_space = kind == _SPACE
        blank = points == 32
        blank_before = np.zeros(n, dtype=bool)
        blank_before[1:] = blank[:-1]
        blank_before[edges] = False
        # A run of white space keeps all but its last character, which stands alone or,
        # if it is a blank, opens the next word; before the end of a piece it keeps all.
        last_space = is_space & (after != _SPACE) & (after != _EDGE)
        starts = np.where(
            is_space, (before != _SPACE) | last_space, (before != kind) & ~blank_before
        )
        # Contractions are cut off where an apostrophe begins a pre-token.
        marks = np.flatnonzero((points == 39) & starts)
        if len(marks):
            piece_end = np.append(edges[edges > 0], n)
            ends = piece_end[np.searchsorted(piece_end, marks, side="right")]
            padded = np.concatenate([points, np.zeros(2, dtype=points.dtype)])
            one, two = padded[marks + 1], padded[marks + 2]
            size = np.zeros(len(marks), dtype=np.int64)
            for word in _CONTRACTIONS:
                fits = one == ord(word[1])
                if len(word) == 3:
                    fits &= two == ord(word[2])
                fits &= marks + len(word) <= ends
                size[fits & (size == 0)] = len(word)
            taken = np.flatnonzero(size)
            inside, stops = marks[taken] + 1, marks[taken] + size[taken]
            starts[inside] = False
            starts[inside[size[taken] == 3] + 1] = False
            starts[stops[stops < n]] = True
        starts[edges] = True
        return np.flatnonzero(starts)

    def _merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number after all merges, for sequences that lie end to end.

        Short sequences of about the same length form a matrix; longer ones stay ragged.
        """
        opens = np.cumsum(lengths) - lengths
        counts = np.empty_like(lengths)
        parts, order = [], []
        below = 0
        for width in _WIDTHS:
            rows = np.flatnonzero((lengths > below) & (lengths <= width))
            below = width
            if len(rows):
                order.append(rows)
                ids, counts[rows] = self._merge_matrix(symbols, opens[rows], lengths[rows], width)
                parts.append(ids)
        rows = np.flatnonzero(lengths > below)
        if len(rows):
            order.append(rows)
            ids, counts[rows] = self._merge_ragged(
                symbols[_ragged(opens[rows], lengths[rows])], lengths[rows]
            )
            parts.append(ids)
        order, flat = np.concatenate(order), np.concatenate(parts)
        begin = np.empty_like(lengths)
        begin[order] = np.cumsum(counts[order]) - counts[order]
        return flat[_ragged(begin, counts)], counts

    def _merge_matrix(self, symbols, opens, lengths, width):
        """The merges of sequences of at most ``width`` symbols, a row each."""
        columns = np.arange(width)
        inside = columns < lengths[:, None]
        table = symbols[np.where(inside, opens[:, None] + columns, 0)]
        ranks = np.full(table.shape, _NO_RANK, dtype=np.int32)
        rows, places = np.nonzero(columns < lengths[:, None] - 1)
        ranks[rows, places] = self._ranks(table[rows, places], table[rows, places + 1])
        result, counts = table.copy(), lengths.copy()
        number, lengths = np.arange(len(lengths)), lengths.copy()
        while len(number):
            place = ranks.argmin(axis=1)
            rank = ranks[np.arange(len(number)), place]
            live = rank != _NO_RANK
            if not live.all():
                result[number[~live]], counts[number[~live]] = table[~live], lengths[~live]
                number, lengths, place, rank = number[live], lengths[live], place[live], rank[live]
                table, ranks = table[live], ranks[live]
                if not len(number):
                    break
            every = np.arange(len(number))
            table[every, place] = self._merged[rank]
            moves = columns[:-1] > place[:, None]
            np.copyto(table[:, :-1], table[:, 1:], where=moves)
            np.copyto(ranks[:, :-1], ranks[:, 1:], where=moves)
            ranks[:, -1] = _NO_RANK
            lengths -= 1
            ranks[every, place] = _NO_RANK
            for shift in (0, 1):
                at = np.flatnonzero((place >= shift) & (place - shift < lengths - 1))
                left = place[at] - shift
                ranks[at, left] = self._ranks(table[at, left], table[at, left + 1])
        return result[columns < counts[:, None]], counts

    def _merge_ragged(self, symbols: np.ndarray, lengths: np.ndarray):
        """The merges of sequences of any length that lie end to end."""
        counts = lengths.copy()
        total = len(lengths)
        done_ids, done_numbers = [], []
        number = np.arange(total)
        lengths = lengths.copy()
        last = np.zeros(len(symbols), dtype=bool)
        last[np.cumsum(lengths) - 1] = True
        ranks = np.full(len(symbols), _NO_RANK, dtype=np.int32)
        inner = np.flatnonzero(~last)
        ranks[inner] = self._ranks(symbols[inner], symbols[inner + 1])
        while len(number):
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(ranks, starts)
            live = lowest != _NO_RANK
            if not live.all():
                ended = np.repeat(~live, lengths)
                done_ids.append(symbols[ended])
                done_numbers.append(number[~live])
                counts[number[~live]] = lengths[~live]
                symbols, ranks, last = symbols[~ended], ranks[~ended], last[~ended]
                number, lengths, lowest = number[live], lengths[live], lowest[live]
                if not len(number):
                    break
                starts = np.cumsum(lengths) - lengths
            hit = ranks == np.repeat(lowest, lengths)
            at = np.flatnonzero(hit)
            # Of overlapping equal pairs (a a a) every second one is joined, from the left.
            touching = np.zeros(len(at), dtype=bool)
            touching[1:] = at[1:] == at[:-1] + 1
            if touching.any():
                order = np.arange(len(at))
                opens = np.maximum.accumulate(np.where(touching, 0, order))
                at = at[(order - opens) % 2 == 0]
            symbols[at] = self._merged[ranks[at]]
            last[at] = last[at + 1]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            owner = np.searchsorted(starts, at, side="right") - 1
            lengths = lengths - np.bincount(owner, minlength=len(lengths))
            at = at - np.arange(len(at))
            symbols, ranks, last = symbols[keep], ranks[keep], last[keep]
            changed = np.unique(np.concatenate([at, at[at > 0] - 1]))
            ranks[changed] = _NO_RANK
            changed = changed[~last[changed]]
            ranks[changed] = self._ranks(symbols[changed], symbols[changed + 1])
        ids = np.concatenate(done_ids) if done_ids else np.zeros(0, dtype=np.int32)
        numbers = np.concatenate(done_numbers) if done_numbers else np.zeros(0, dtype=np.int64)
        ended_at = np.cumsum(counts[numbers]) - counts[numbers]
        begin = np.empty(total, dtype=np.int64)
        begin[numbers] = ended_at
        return ids[_ragged(begin, counts)], counts

    def _encoded(self, texts: list[str]):
        """Per pre-token its piece and its row in a table of distinct pre-tokens; an array
        of ids with begin and number for each of those; pieces as in ``_segments``."""
        pieces, owner, ending = self._segments(texts)
        blob = "".join(pieces)
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        none = np.zeros(0, dtype=np.int64)
        if not blob:
            return none, none, none.astype(np.int32), none, none, owner, ending
        points = np.frombuffer(blob.encode("utf-32-le"), dtype=np.uint32)
        opens = np.cumsum(sizes) - sizes
        full = np.flatnonzero(sizes)
        starts = self._starts(points, opens[full])
        piece = full[np.searchsorted(opens[full], starts, side="right") - 1]
        data = blob.encode("utf-8")
        width = (
            1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        )
        place = np.cumsum(width) - width
        begin = place[starts]
        length = np.diff(np.append(begin, len(data)))
        padded = np.frombuffer(data + bytes(16), dtype=np.uint8)
        words = np.lib.stride_tricks.as_strided(
            padded[:8].view("<u8"), shape=(len(data) + 9,), strides=(1,), writeable=False
        )
        low = words[begin] & _LOW_BYTES[np.minimum(length, 8)]
        high = words[begin + np.minimum(length, 8)] & _LOW_BYTES[np.clip(length - 8, 0, 8)]
        mix = low * np.uint64(0x9E3779B97F4A7C15)
        mix ^= mix >> np.uint64(29)
        mix += high * np.uint64(0xC2B2AE3D27D4EB4F) + length.astype(np.uint64)
        mix *= np.uint64(0x165667B19E3779F9)
        _, first, row = np.unique(mix, return_index=True, return_inverse=True)
        same = first[row]
        # Up to 15 bytes the two words are the pre-token; whatever is longer, or differs
        # from the first with its mixed word, is kept by itself.
        alone = np.flatnonzero(
            (length > 15) | (low[same] != low) | (high[same] != high) | (length[same] != length)
        )
        row[alone] = len(first) + np.arange(len(alone))

        def merge(chosen):
            symbols = self._byte_ids[padded[_ragged(begin[chosen], length[chosen])]]
            return self._merge(symbols, length[chosen])

        # The length is part of the mixed word and, below 16 bytes, told by zero bytes in
        # all but texts with NUL; it joins the high word so that those differ as well.
        tagged = high ^ (length.astype(np.uint64) << np.uint64(59))
        where, counts = self._remembered(
            mix[first], low[first], tagged[first], length[first], lambda new: merge(first[new])
        )
        if len(alone):
            ids, more = merge(alone)
            where = np.append(where, len(self._known_ids) + np.cumsum(more) - more)
            counts = np.append(counts, more)
            ids = np.concatenate([self._known_ids, ids])
        else:
            ids = self._known_ids
        return piece, row, ids, where, counts, owner, ending

    def counts(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of every text."""
        piece, row, _, _, counts, owner, ending = self._encoded(texts)
        per_piece = np.bincount(piece, weights=counts[row], minlength=len(owner)) + (ending >= 0)
        return np.bincount(owner, weights=per_piece, minlength=len(texts)).astype(np.int64)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end and their number per text."""
        piece, row, ids, begin, counts, owner, ending = self._encoded(texts)
        flat = ids[_ragged(begin[row], counts[row])]
        per_piece = np.bincount(piece, weights=counts[row], minlength=len(owner)).astype(np.int64)
        special = ending >= 0
        flat = np.insert(flat, np.cumsum(per_piece)[special], ending[special])
        total = np.bincount(owner, weights=per_piece + special, minlength=len(texts))
        return flat, total.astype(np.int64)


@lru_cache(maxsize=4)
def load(path: str) -> ByteBpe:
    """The vocabulary of a file, read once per worker."""
    return ByteBpe(path)
