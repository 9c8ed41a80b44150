"""Byte-pair encoding and decoding of whole texts, by speculation and verification.

A word's greedy longest-match split is a guess. It is right exactly when no merge could have crossed
the border of two neighbouring tokens while both sides were still in parts, so every distinct pair of
neighbours is tested once, as arrays, against the spines of the two tokens' merge trees. Words with a
failing pair are merged step by step. Guesses and merges take thousands of words at once, a step of all of
them at a time. Results are kept by distinct word in each Python worker; Arrow finds the distinct strings.
"""

from __future__ import annotations

import heapq
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEEP = 800_000  # distinct strings a worker remembers before it starts anew
SHORT = 40  # characters up to which a word is merged by plain scans
TOGETHER = 4096  # words guessed and merged at once
SLICE = 1 << 21  # characters handled at once
_LAST = 1 << 40
_NEVER = np.int64(_LAST)
_ENDS = 256  # added to the last byte of a word
# Characters on whose class and lower case all libraries agree; other texts go through the tokenizer's own normaliser.
_ASCII = bytes([*range(0x09, 0x0E), *range(0x20, 0x7F)])
_OTHER = regex.compile("[^\t-\r -~\xa1-ɏ‐-‧‰-⁞]")


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where printable in Latin-1, else the next code points from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Places:
    """Places of distinct keys (integers from 0) for whole arrays of keys, by one hashed table."""

    def __init__(self, keys: np.ndarray):
        bits = max(2, (2 * len(keys)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys, self._place = np.full(1 << bits, -1), np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(keys)), self._start(keys)
        while len(left):
            free = np.flatnonzero(self._keys[at] < 0)
            slots, first = np.unique(at[free], return_index=True)
            put = free[first]
            self._keys[slots], self._place[slots] = keys[left[put]], left[put]
            left, at = np.delete(left, put), (np.delete(at, put) + 1) & self._mask

    def _start(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for others."""
        at = self._start(keys)
        there = self._keys[at]
        place = np.where(there == keys, self._place[at], -1).astype(np.int64)
        go = np.flatnonzero((there != keys) & (there >= 0))
        while len(go):
            at[go] = (at[go] + 1) & self._mask
            there = self._keys[at[go]]
            hit = there == keys[go]
            place[go[hit]] = self._place[at[go[hit]]]
            go = go[~hit & (there >= 0)]
        return place


class Model:
    """Merge trees and word splitting of a tokenizer file (JSON text of the tokenizers library)."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: s for s, i in (*self.vocab.items(), *self.special.items())}
        self.names = np.array([names.get(i, "") for i in range(max(names) + 1)], object)
        self._special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._spec, self._library = text, None
        self._pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self._letters = byte_letters()
        self._ascii = str.maketrans({chr(b): self._letters[b] for b in range(128)})
        self._ends = _ENDS if self.suffix else 0
        self._unit = np.array([self.vocab.get(c + end, -1) for end in ("", self.suffix) for c in self._letters])

        n, merges = len(self.names), [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        v = self.vocab
        self.rank = {(v[a], v[b]): r for r, (a, b) in enumerate(merges)}
        self.whole = {(v[a], v[b]): v[a + b] for a, b in merges}
        self.made = np.full(n, _NEVER)  # rank of the merge that makes a token
        self.left, self.right = np.full(n, -1), np.full(n, -1)
        for (a, b), r in self.rank.items():
            t = self.whole[a, b]
            self.made[t], self.left[t], self.right[t] = r, a, b
        self._merges = Places(np.array([a * n + b for a, b in self.rank], np.int64))
        self._ranks = np.array([*self.rank.values(), _LAST], np.int64)  # the last for pairs that never merge
        self._made_by = np.full(len(merges), -1)
        self._made_by[self._ranks[:-1]] = list(self.whole.values())
        # a token may be proposed if its own characters merge into it
        sound = np.array([self.left[t] >= 0 or len(s.removesuffix(self.suffix) or s) == 1 for t, s in enumerate(self.names)])
        t = np.flatnonzero(self.left >= 0)
        sound[t[~self._apart(self.left[t], self.right[t], self.made[t])]] = False
        for x in t[np.argsort(self.made[t])]:
            sound[x] &= sound[self.left[x]] and sound[self.right[x]]
        self.proposed = {s: i for s, i in v.items() if sound[i]}
        self._longest = max(len(s) for s in self.proposed)
        # a tree of the proposed tokens' bytes: node k + 1 is the k-th key (node above, byte)
        letter, nodes, accepts = {c: b for b, c in enumerate(self._letters)}, {}, [-1]
        for s, i in self.proposed.items():
            part = [letter.get(c, -1) for c in (s.removesuffix(self.suffix) if self.suffix else s)]
            if not part or min(part) < 0:
                continue
            if self.suffix and s.endswith(self.suffix):
                part[-1] += _ENDS
            node = 0
            for x in part:
                below = nodes.setdefault(node * 2 * _ENDS + x, len(accepts))
                if below == len(accepts):
                    accepts.append(-1)
                node = below
            accepts[node] = i
        self._below, self._accepts = Places(np.fromiter(nodes, np.int64, len(nodes))), np.array(accepts)
        self._pairs: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self._flat, self._first = np.zeros(0, np.int32), np.zeros(1, np.int64)  # ids of the strings, in the order of the index
        self._word_flat, self._word_first = np.zeros(0, np.int32), np.zeros(1, np.int64)  # and of the words

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self._ranks[self._merges.find(a * len(self.names) + b)]

    def _apart(self, a: np.ndarray, b: np.ndarray, until: np.ndarray) -> np.ndarray:
        """Whether tokens a and b, side by side, stay unmerged across their border before rank ``until``."""
        apart = np.ones(len(a), bool)
        rows, x, x_end = np.arange(len(a)), a.copy(), until.copy()
        while len(rows):  # down the right edge of a
            cells, y, y_end = np.arange(len(rows)), b[rows], until[rows]
            while len(cells):  # down the left edge of b
                r = self._pair_rank(x[cells], y)
                # at one rank the leftmost pair merges first, so a's own merge wins a tie and b's loses it
                bad = (r < x_end[cells]) & (r <= y_end) & (r < until[rows[cells]])
                apart[rows[cells[bad]]] = False
                y_end, y = self.made[y], self.left[y]
                go = (y >= 0) & ~bad
                cells, y, y_end = cells[go], y[go], y_end[go]
            x_end, x = self.made[x], self.right[x]
            go = (x >= 0) & apart[rows]
            rows, x, x_end = rows[go], x[go], x_end[go]
        return apart

    def _guess(self, word: str) -> list[int] | None:
        """Greedy longest match; None if some part has no token."""
        ids, at, n, get = [], 0, len(word), self.proposed.get
        while at < n:
            for to in range(min(n, at + self._longest), at, -1):
                found = get(word[at:to] + self.suffix if to == n else word[at:to])
                if found is not None:
                    break
            else:
                return None
            ids.append(found)
            at = to
        return ids

    def merge(self, word: str) -> list[int]:
        """Exact encoding of one word: the lowest rank merges first, from the left among equals."""
        parts = [self.vocab.get(c) for c in word[:-1]] + [self.vocab.get(word[-1] + self.suffix)]
        parts = [p for p in parts if p is not None]
        n = len(parts)
        if n <= SHORT:
            get = self.rank.get
            ranks = [get(p, _LAST) for p in zip(parts, parts[1:])]
            while ranks and (r := min(ranks)) != _LAST:
                i = ranks.index(r)
                parts[i : i + 2] = [self.whole[parts[i], parts[i + 1]]]
                del ranks[i]
                if i:
                    ranks[i - 1] = get((parts[i - 1], parts[i]), _LAST)
                if i < len(ranks):
                    ranks[i] = get((parts[i], parts[i + 1]), _LAST)
            return parts
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(self.rank[p], i, *p) for i in range(n - 1) if (p := (parts[i], parts[i + 1])) in self.rank]
        heapq.heapify(queue)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j], after[i] = self.whole[a, b], -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (p := (parts[k], parts[after[k]])) in self.rank:
                    heapq.heappush(queue, (self.rank[p], k, *p))
        return [p for p in parts if p >= 0]

    def _guesses(self, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of many words: (a row of ids for each, -1 behind them; whether every part has a token)."""
        out, n = np.full((len(size), int(size.max())), -1), np.zeros(len(size), np.int64)
        live, at, end = np.arange(len(size)), first.copy(), first + size
        node, best, best_at, found = np.zeros(len(size), np.int64), np.full(len(size), -1), at.copy(), np.ones(len(size), bool)
        while len(live):
            node = np.where(at < end, self._below.find(node * 2 * _ENDS + data[np.minimum(at, len(data) - 1)]) + 1, 0)
            at = at + (node > 0)
            token = self._accepts[node]
            best, best_at = np.where(token >= 0, token, best), np.where(token >= 0, at, best_at)
            stop = np.flatnonzero(node == 0)
            if not len(stop):
                continue
            found[live[stop[best[stop] < 0]]] = False
            put = stop[best[stop] >= 0]
            rows = live[put]
            out[rows, n[rows]] = best[put]
            n[rows] += 1
            ended = np.concatenate((stop[best[stop] < 0], put[best_at[put] == end[put]]))
            at[put], best[put] = best_at[put], -1
            if len(ended):
                go = np.ones(len(live), bool)
                go[ended] = False
                live, at, end, node, best, best_at = (x[go] for x in (live, at, end, node, best, best_at))
        return out, found

    def _merged(self, parts: np.ndarray) -> np.ndarray:
        """Exact encoding of many words, a row of parts for each, -1 behind them: each step merges one pair of every row."""
        out, live, n = np.full_like(parts, -1), np.arange(len(parts)), parts.shape[1]
        parts, places = parts.copy(), np.arange(n)
        ranks = np.full(parts.shape, _NEVER)  # of a part and the next
        ranks[:, :-1] = np.where(parts[:, 1:] >= 0, self._pair_rank(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(len(parts), n - 1), _NEVER)
        while len(live):
            at = ranks.argmin(1)  # the leftmost of the lowest
            low = ranks[np.arange(len(live)), at]
            ended = low == _NEVER
            if ended.any():
                out[live[ended]] = parts[ended]
                parts, ranks, live, at, low = (x[~ended] for x in (parts, ranks, live, at, low))
            rows, behind = np.arange(len(live)), places[:-1] > at[:, None]
            parts[:, :-1] = np.where(behind, parts[:, 1:], parts[:, :-1])
            ranks[:, :-1] = np.where(behind, ranks[:, 1:], ranks[:, :-1])
            parts[:, -1], ranks[:, -1] = -1, _NEVER
            whole = self._made_by[low]
            parts[rows, at] = whole
            after = parts[rows, np.minimum(at + 1, n - 1)]
            ranks[rows, at] = np.where(after >= 0, self._pair_rank(whole, np.maximum(after, 0)), _NEVER)
            k = np.flatnonzero(at)
            ranks[k, at[k] - 1] = self._pair_rank(parts[k, at[k] - 1], whole[k])
        return out

    def _fits(self, ids: np.ndarray) -> np.ndarray:
        """Whether all neighbours of each row stay apart; every distinct pair is tested once."""
        n = len(self.names)
        rows, at = np.nonzero(ids[:, 1:] >= 0)
        distinct, where = np.unique(ids[rows, at] * n + ids[rows, at + 1], return_inverse=True)
        if len(self._pairs) > 2 * KEEP:
            self._pairs.clear()
        fresh = np.array([k for k in distinct.tolist() if k not in self._pairs], np.int64)
        if len(fresh):
            apart = self._apart(fresh // n, fresh % n, np.full(len(fresh), _NEVER))
            self._pairs.update(zip(fresh.tolist(), apart.tolist()))
        good = np.array([self._pairs[k] for k in distinct.tolist()], bool)
        fits = np.ones(len(ids), bool)
        fits[rows[~good[where]]] = False
        return fits

    def learn(self, pieces: list[str]) -> None:
        """Encode distinct words and remember them."""
        raw = [p.encode() for p in pieces]
        size = np.array([len(r) for r in raw])
        data, ends = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64), np.cumsum(size)
        data[ends - 1] += self._ends
        first, order = ends - size, np.argsort(size, kind="stable")
        known = np.minimum.reduceat(self._unit[data], first) >= 0
        plain = order[known[order] & (size[order] <= SHORT)]
        flat, sizes = [], []
        for a in range(0, len(plain), TOGETHER):
            some = plain[a : a + TOGETHER]
            ids, found = self._guesses(data, first[some], size[some])
            wrong = np.flatnonzero(~(found & self._fits(ids)))
            if len(wrong):
                places = np.arange(ids.shape[1])
                inside = places < size[some[wrong]][:, None]
                ids[wrong] = self._merged(np.where(inside, self._unit[data[np.where(inside, first[some[wrong]][:, None] + places, 0)]], -1))
            flat.append(ids[ids >= 0])
            sizes.append((ids >= 0).sum(1))
        others = np.setdiff1d(order, plain)
        for i in others.tolist():  # long words one by one
            word = "".join(self._letters[b] for b in raw[i])
            ids = self._guess(word)
            if ids is None or not self._fits(np.array([ids]))[0]:
                ids = self.merge(word)
            flat.append(np.array(ids, np.int64))
            sizes.append(np.array([len(ids)]))
        done = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        back = np.argsort(np.concatenate((plain, others)))  # in the order of the pieces again
        ids, first = _taken(np.concatenate(flat).astype(np.int32), done, back, np.ones(len(back), np.int64))
        self.words.update(zip(pieces, itertools.count(len(self.words))))
        self._word_first = np.concatenate((self._word_first, first[1:] + len(self._word_flat)))
        self._word_flat = np.concatenate((self._word_flat, ids))

    def strings(self, text: str) -> list[str]:
        """A text's strings between white space, special tokens, and words where white space is not plain."""
        out: list[str] = []
        parts = self._special.split(text) if self._special and any(s in text for s in self.special) else [text]
        for part in parts:
            if part in self.special:
                out.append(part)
            elif _OTHER.search(part) is None:
                out += part.lower().split()
            else:
                if self._library is None:
                    from tokenizers import Tokenizer

                    self._library = Tokenizer.from_str(self._spec)
                letters = {c: b for b, c in enumerate(self._letters)}
                plain = self._library.normalizer.normalize_str(part)
                pieces = [bytes(letters[c] for c in p).decode() for p, _ in self._library.pre_tokenizer.pre_tokenize_str(plain)]
                self.own.update(pieces)
                out += pieces
        return out

    def remember(self, strings: list[str]) -> None:
        """Encode the words of distinct strings, and keep the ids of each string."""
        special = {t: [self.special[t]] for t in self.special.keys() & strings}
        split = [[t] if t.isalpha() else [] if t in special else [t] if t in self.own else self._pieces.findall(t) for t in strings]
        new = [p for p in dict.fromkeys(itertools.chain.from_iterable(split)) if p not in self.words]
        if new:
            self.learn(new)
        flat, first = _gathered(self._word_flat, self._word_first, split, self.words)
        if special:
            parts = [special.get(t, flat[a:b]) for t, a, b in zip(strings, first[:-1], first[1:])]
            flat, first = np.concatenate(parts).astype(np.int32), np.cumsum([0, *map(len, parts)])
        self.index.update(zip(strings, itertools.count(len(self.index))))
        self._first = np.concatenate((self._first, first[1:] + len(self._flat)))
        self._flat = np.concatenate((self._flat, flat))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, first id of each text and the total)."""
        if len(self.index) + len(self.words) > 2 * KEEP:
            self.forget()
        self.own: set[str] = set()
        odd = {i: self.strings(t) for i, t in enumerate(texts) if any(s in t for s in self.special) or not _plain(t)}
        split = pc.ascii_split_whitespace(pa.array(["" if i in odd else t.lower() for i, t in enumerate(texts)], pa.large_string()))
        first, found = split.offsets.to_numpy(), split.values.dictionary_encode()
        distinct = found.dictionary.to_numpy(zero_copy_only=False).tolist()  # '' where a text begins or ends with white space
        place = np.fromiter(map(self.index.get, distinct, itertools.repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(place < 0)
        if len(new):
            place[new] = len(self.index) + np.arange(len(new))
            self.remember([distinct[i] for i in new.tolist()])
        if others := [t for t in dict.fromkeys(itertools.chain(*odd.values())) if t not in self.index]:
            self.remember(others)
        at, n = place[found.indices.to_numpy()], np.diff(first)
        if odd:
            parts, a = [], 0
            for i, strings in odd.items():
                parts += [at[first[a] : first[i]], _numbers(self.index, strings)]
                n[i], a = len(strings), i + 1
            at = np.concatenate((*parts, at[first[a] :]))
        return _taken(self._flat, self._first, at, n)

    def decode(self, ids: np.ndarray) -> str:
        """Token strings joined by spaces, as a tokenizer without decoder gives them."""
        return " ".join(self.names[ids].tolist())


def _plain(text: str) -> bool:
    return not text.encode().translate(None, _ASCII) if text.isascii() else _OTHER.search(text) is None


def _numbers(index: dict[str, int], strings: list[str]) -> np.ndarray:
    return np.fromiter(map(index.__getitem__, strings), np.int64, len(strings))


def _taken(flat: np.ndarray, first: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``at`` of those strung together in ``flat``; where every n of them begin, and the total."""
    size = first[at + 1] - first[at]
    ends = np.concatenate(([0], np.cumsum(size)))
    take = np.arange(ends[-1]) + np.repeat(first[at] - ends[:-1], size)
    return flat[take], ends[np.concatenate(([0], np.cumsum(n)))]


def _gathered(flat: np.ndarray, first: np.ndarray, split: list[list[str]], index: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    return _taken(flat, first, _numbers(index, list(itertools.chain.from_iterable(split))), np.array([len(x) for x in split], np.int64))


def vocabulary_size(path: str) -> int:
    """One more than the largest id of the tokenizer file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return 1 + max(*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"]))


_models: dict[int, Model] = {}


def encoded(docs: DataFrame, path: str, with_text: bool = True, in_bytes: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array<int>, or binary of 4 bytes an id, little-endian) of every whole text and, if wanted,
    ``decoded`` read back from them.

    Null text counts as empty: no ids, decoded ''. Further columns stay, but any called ids or decoded give way. ``path`` names the tokenizer file
    on the driver; executors get its content.
    """
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    docs = docs.drop("ids", "decoded")
    at = docs.columns.index("text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(spec.value)
        model = _models.get(key)
        if model is None:
            _models.clear()
            model = _models[key] = Model(spec.value)
        for batch in batches:
            texts, a = batch.column(at), 0
            while a < len(batch):
                b, size, part = a, 0, []
                while b < len(batch) and (not part or size < SLICE):
                    part.append(texts[b].as_py() or "")
                    size += len(part[-1])
                    b += 1
                flat, cut = model.encode(part)
                if in_bytes:
                    ids = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(4 * cut), pa.py_buffer(flat.astype("<i4"))]).cast(pa.binary())
                else:
                    ids = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(flat))
                columns = [*batch.slice(a, b - a).columns, ids]
                if with_text:
                    columns.append(pa.array([model.decode(flat[s:e]) for s, e in zip(cut[:-1], cut[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "ids", *["decoded"] * with_text])
                a = b

    fields = T.StructType([*docs.schema.fields, T.StructField("ids", T.BinaryType() if in_bytes else T.ArrayType(T.IntegerType()))] + [T.StructField("decoded", T.StringType())] * with_text)
    return docs.mapInArrow(of, fields)
