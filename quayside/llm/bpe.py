"""BPE encoding by speculation and verification, and decoding.

Greedy longest match proposes a word's tokens. The proposal is the exact result if every
token re-encodes to itself and no merge would cross any boundary between neighbours; both
are checked for all words of a batch at once on arrays. Only words that fail are merged
exactly, lowest rank first. Reads the tokenizers library's JSON form of a word-final BPE:
NFC and lower case, added tokens cut out first, byte-level symbols, a suffix on the last.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import ship

ROWS, WIDE = 8192, 192  # words side by side; longer ones go one by one
CACHE_WORDS = 300_000  # pieces a worker remembers; then it starts afresh
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = regex.compile(rf"[^{WHITE}]+")
NONE = np.int64(2**31)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 stands for
    itself, the rest for characters from 256 on in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def pieces(text: str) -> list[str]:
    """Runs of other than white space, which no token crosses; str.split() differs in
    taking four control characters for white space."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return PIECES.findall(text)
    return text.split()


class Tokenizer:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.cut_start = regex.compile("[" + "".join(sorted({regex.escape(t[0]) for t in self.added})) + "]") if self.added else None
        self.names = {i: s for s, i in (self.vocab | self.added).items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        n = len(self.vocab)
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        self.left, self.right, self.formed = np.full(n, -1), np.full(n, -1), np.full(n, NONE)
        for rank, (a, b) in enumerate(merges):
            a, b, t = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.ranks[a, b] = (rank, t)
            self.left[t], self.right[t], self.formed[t] = a, b, rank
        keys = np.array([a << 20 | b for a, b in self.ranks], np.int64)
        order = np.argsort(keys)
        self.keys, self.key_ranks = keys[order], np.array([r for r, _ in self.ranks.values()])[order]
        self.by_rank = np.array([t for _, t in self.ranks.values()], np.int64)
        self._trie()
        self.left_spine, self.left_gone = self._spine(self.left)
        self.right_spine, self.right_gone = self._spine(self.right)
        self.stable = self._stable()
        self.numbers = {i: str(i) for i in self.names}
        self.pairs: dict[int, bool] = {}
        self.id_names: dict[str, str] = {}  # two flat caches: nothing for the garbage collector
        self.decoded: dict[str, str] = {}

    def _spine(self, child: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per depth: the outermost part of every token, and the rank of the merge that
        takes it up into the part above (NONE for the token itself)."""
        part, gone = np.arange(len(child)), np.full(len(child), NONE)
        parts, gones = [part], [gone]
        while (part >= 0).any():
            gone = np.where(part >= 0, self.formed[part], 0)
            part = np.where(part >= 0, child[part], -1)
            parts.append(part), gones.append(gone)
        return parts[:-1], gones[:-1]

    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of a and b; NONE where there is none (-1: no token)."""
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.key_ranks[at], NONE)

    def _joins(self, a: np.ndarray, b: np.ndarray, whole_too: bool) -> np.ndarray:
        """Would a merge join some right part of a to some left part of b while both are
        there? Equal ranks go to the leftmost: a's own merge comes first, b's later."""
        bad = np.zeros(len(a), bool)
        for i, (rp, rg) in enumerate(zip(self.right_spine, self.right_gone, strict=True)):
            x, x_gone = rp[a], rg[a]
            if not (x >= 0).any():
                break
            for j, (lp, lg) in enumerate(zip(self.left_spine, self.left_gone, strict=True)):
                if i == j == 0 and not whole_too:
                    continue
                y = lp[b]
                on = np.flatnonzero((x >= 0) & (y >= 0) & ~bad)
                if not len(on):
                    if not (y >= 0).any():
                        break
                    continue
                rank = self._pair_ranks(x[on], y[on])
                bad[on] = (rank < x_gone[on]) & (rank <= lg[b[on]]) & (rank < NONE)
        return bad

    def _stable(self) -> np.ndarray:
        """Tokens whose own text encodes to just them."""
        made = np.flatnonzero(self.left >= 0)
        made = made[np.argsort(self.formed[made])]
        ok = np.ones(len(self.left), bool)
        ok[made] = ~self._joins(self.left[made], self.right[made], whole_too=False)
        for t in made.tolist():
            ok[t] = ok[t] and ok[self.left[t]] and ok[self.right[t]]
        return ok

    def _trie(self) -> None:
        """Token texts as byte paths: sorted (node, byte) keys with the node below, and
        each node's token, plain and word-final."""
        below: dict[int, int] = {}
        plain, final = {}, {}
        to_byte = {c: b for b, c in enumerate(byte_symbols())}
        for text, t in self.vocab.items():
            end = bool(self.suffix) and text.endswith(self.suffix)
            node = 0
            for c in text[: -len(self.suffix)] if end else text:
                node = below.setdefault(node << 8 | to_byte[c], len(below) + 1)
            (final if end else plain)[node] = t
        self.below = below
        keys = np.fromiter(below, np.int64, len(below))
        order = np.argsort(keys)
        self.trie_keys, self.trie_nodes = keys[order], np.fromiter(below.values(), np.int64, len(below))[order]
        self.plain, self.final = np.full(len(below) + 1, -1), np.full(len(below) + 1, -1)
        for table, found in ((self.plain, plain), (self.final, final if self.suffix else plain)):
            table[list(found)] = list(found.values())
        self.byte_ids = [np.array([table[self._down(np.zeros(1, np.int64), np.array([b]))[0]] for b in range(256)]) for table in (self.plain, self.final)]

    def _down(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = node << 8 | byte
        at = np.minimum(np.searchsorted(self.trie_keys, key), len(self.trie_keys) - 1)
        return np.where(self.trie_keys[at] == key, self.trie_nodes[at], -1)

    def greedy(self, text: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Longest matches from the left, for rows of bytes of the given sizes at once."""
        n, width = text.shape
        out = np.full((n, width + 1), -1, np.int64)
        row, size = np.arange(n), size.copy()
        start, at, node, tokens = (np.zeros(n, np.int64) for _ in range(4))
        best, best_end = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        while len(row):
            more = at < size
            to = np.where(more, self._down(node, text[row, np.minimum(at, width - 1)]), -1)
            on = to >= 0
            node, at = np.where(on, to, node), at + on
            token = np.where(at == size, self.final[node], self.plain[node])
            hit = on & (token >= 0)
            best, best_end = np.where(hit, token, best), np.where(hit, at, best_end)
            stop = ~on
            out[row[stop], tokens[stop]] = best[stop]
            tokens += stop
            start, at, node = np.where(stop, best_end, start), np.where(stop, best_end, at), np.where(stop, 0, node)
            live = ~stop | (start < size)
            if not live.all():
                row, size, start, at, node, tokens, best, best_end = (x[live] for x in (row, size, start, at, node, tokens, best, best_end))
        return out

    def greedy_word(self, word: bytes) -> np.ndarray:
        """The same for one long word."""
        below, size, at, out = self.below, len(word), 0, []
        while at < size:
            node, best, end = 0, -1, at + 1
            for k in range(at, size):
                node = below.get(node << 8 | word[k], -1)
                if node < 0:
                    break
                token = int((self.final if k + 1 == size else self.plain)[node])
                if token >= 0:
                    best, end = token, k + 1
            out.append(best)
            at = end
        return np.array(out, np.int64)

    def merge_rows(self, text: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Exact merging of rows of bytes, always the lowest rank and leftmost first: one
        merge in each row at a time."""
        n, width = text.shape
        ids = np.full((n, width + 1), -1, np.int64)
        ids[:, :width] = np.where(np.arange(width) < size[:, None], self.byte_ids[0][text], -1)
        last = text[np.arange(n), size - 1]
        ids[np.arange(n), size - 1] = self.byte_ids[1][last]
        rank = np.full(ids.shape, NONE)
        rank[:, :-1] = self._pair_ranks(ids[:, :-1], ids[:, 1:])
        live, cols = np.arange(n), np.arange(width + 1)
        while True:
            at = rank[live].argmin(1)
            on = rank[live, at] < NONE
            live, at = live[on], at[on]
            if not len(live):
                return ids
            new = self.by_rank[rank[live, at]]
            step = (cols + (cols > at[:, None])).clip(max=width)  # close the gap
            moved, moved_rank = np.take_along_axis(ids[live], step, 1), np.take_along_axis(rank[live], step, 1)
            moved[:, -1], moved_rank[:, -1] = -1, NONE
            r = np.arange(len(live))
            moved[r, at] = new
            moved_rank[r, at] = self._pair_ranks(new, moved[r, np.minimum(at + 1, width)])
            has = np.flatnonzero(at > 0)
            moved_rank[has, at[has] - 1] = self._pair_ranks(moved[has, at[has] - 1], new[has])
            ids[live], rank[live] = moved, moved_rank

    def merge(self, word: bytes) -> list[int]:
        """Exact merging of one word by a heap of (rank, place)."""
        ids = [*self.byte_ids[0][list(word[:-1])].tolist(), int(self.byte_ids[1][word[-1]])]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(self.ranks[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.ranks]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            nxt = after[k]
            found = self.ranks.get((ids[k], ids[nxt])) if ids[k] >= 0 and nxt < len(ids) else None
            if not found or found[0] != rank:
                continue
            ids[k], ids[nxt], after[k] = found[1], -1, after[nxt]
            if after[k] < len(ids):
                before[after[k]] = k
            for i, j in ((before[k], k), (k, after[k])):
                if i >= 0 and j < len(ids) and (found := self.ranks.get((ids[i], ids[j]))):
                    heapq.heappush(heap, (found[0], i))
        return [t for t in ids if t >= 0]

    def verified(self, ids: np.ndarray) -> np.ndarray:
        """Which rows of proposed ids (-1 behind the last) are exact."""
        ok = np.where(ids >= 0, self.stable[ids], True).all(1)
        row, col = np.nonzero(ids[:, 1:] >= 0)
        key, back = np.unique(ids[row, col] << 20 | ids[row, col + 1], return_inverse=True)
        known = [self.pairs.get(k) for k in key.tolist()]
        fresh = np.array([k for k, bad in enumerate(known) if bad is None], np.int64)
        if len(fresh):
            joins = self._joins(key[fresh] >> 20, key[fresh] & 0xFFFFF, whole_too=True)
            if len(self.pairs) > CACHE_WORDS:
                self.pairs.clear()
            for k, bad in zip(fresh.tolist(), joins.tolist(), strict=True):
                known[k] = self.pairs[int(key[k])] = bad
        ok[row[np.array(known, bool)[back]]] = False
        return ok

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of words (UTF-8), in rows of like size; very long ones one by one."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        out: list[list[int]] = [[]] * len(words)
        for k in np.flatnonzero(lens > WIDE).tolist():
            ids = self.greedy_word(words[k])
            out[k] = ids.tolist() if self.verified(ids[None, :])[0] else self.merge(words[k])
        order = np.argsort(lens, kind="stable")
        order = order[lens[order] <= WIDE]
        for lo in range(0, len(order), ROWS):
            part = order[lo : lo + ROWS]
            size = lens[part]
            flat = np.frombuffer(b"".join([words[k] for k in part.tolist()]), np.uint8).astype(np.int64)
            text = np.zeros((len(part), int(size.max())), np.int64)
            text[np.arange(text.shape[1]) < size[:, None]] = flat
            ids = self.greedy(text, size)
            bad = np.flatnonzero(~self.verified(ids))
            if len(bad):
                ids[bad] = self.merge_rows(text[bad], size[bad])
            for k, own, n in zip(part.tolist(), ids.tolist(), (ids >= 0).sum(1).tolist(), strict=True):
                out[k] = own[:n]
        return out

    def _ids(self, pieces: set[str]) -> dict[str, list[int]]:
        """Ids of white-space separated pieces."""
        single, parts, words = {}, {}, {}
        for piece in pieces:
            if piece.isalpha() and "\u03a3" not in piece:  # letters are one word
                word = piece.lower()
                if not piece.isascii():
                    word = unicodedata.normalize("NFC", piece).lower()
                    if not word.isalpha():  # lower-casing made a mark
                        parts[piece] = self._split(piece, words)
                        continue
                single[piece] = word = word.encode()
                words[word] = None
            else:
                parts[piece] = self._split(piece, words)
        names = list(words)
        words = dict(zip(names, self.encode_words(names), strict=True))
        out = {piece: words[word] for piece, word in single.items()}
        for piece, own in parts.items():
            out[piece] = [t for x in own for t in (words[x] if isinstance(x, bytes) else [x])]
        return out

    def _split(self, piece: str, words: dict) -> list:
        own = []
        for k, part in enumerate(self.cut.split(piece) if self.cut and self.cut_start.search(piece) else [piece]):
            if k % 2:
                own.append(self.added[part])
            elif part:
                part = unicodedata.normalize("NFC", part)
                part = part.lower() if "\u03a3" not in part else "".join(c.lower() for c in part)
                for word in self.words.findall(part):
                    own.append(word := word.encode())
                    words[word] = None
        return own

    def written(self, texts: list[str]) -> list[tuple[str, str]]:
        """Each text's ids written out, and its decoded text."""
        found = [pieces(t) for t in texts]
        names, words, numbers = self.id_names, self.decoded, self.numbers
        if len(names) > CACHE_WORDS:
            names.clear(), words.clear()
        if new := set().union(*found).difference(names):
            for piece, ids in self._ids(new).items():
                names[piece] = " ".join([numbers[t] for t in ids])
                words[piece] = self.decode(ids)
        return [(" ".join(map(names.__getitem__, f)), " ".join(map(words.__getitem__, f))) for f in found]

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = [pieces(t) for t in texts]
        ids = self._ids(set().union(*found))
        return [[t for p in f for t in ids[p]] for f in found]

    def decode(self, ids: list[int]) -> str:
        """Token texts joined by a space, as a tokenizer without a decoder does; unknown
        ids are left out."""
        return " ".join([self.names[i] for i in ids if i in self.names])


@functools.lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    return Tokenizer(path)


def _texts(column: pa.Array) -> list[str]:
    return column.fill_null("").to_pylist()


def encode(text: Column, path: str) -> Column:
    """Token ids of a text column; null counts as empty, which has no ids."""

    ship(SparkSession.active())

    @F.arrow_udf("array<int>")
    def run(column: pa.Array) -> pa.Array:
        return pa.array(load(path).encode(_texts(column)), pa.list_(pa.int32()))

    return run(text)


def decode(ids: Column, path: str) -> Column:
    """Text of token ids; null gives null."""

    ship(SparkSession.active())

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        t = load(path)
        return pa.array([None if x is None else t.decode(x) for x in column.to_pylist()], pa.string())

    return run(ids)


def token_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row's whole text; a null text
    counts as empty. Repeated rows give repeated results, an empty table none."""

    ship(df.sparkSession)

    @F.arrow_udf("struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>")
    def run(column: pa.Array) -> pa.Array:
        n, ids, decoded = [], [], []
        for names, text in load(path).written(_texts(column)):
            n.append(names.count(" ") + 1 if names else 0)
            ids.append(hashlib.sha256(names.encode()).hexdigest())
            decoded.append(hashlib.sha256(text.encode()).hexdigest())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), run(F.col(text_col).cast("string")).alias("t")).select("doc_id", "t.*")
