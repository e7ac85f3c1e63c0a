"""BPE encoding and decoding by speculation.

1. *Speculate.* A word is cut greedily into the longest vocabulary entries: all
   words of a batch walk a trie of the entries together in numpy.
2. *Verify.* Each adjacent pair of proposed tokens is tested, all pairs of all
   words at once in numpy: a merge over the border between two tokens would
   have to join a part of the left one's right edge with a part of the right
   one's left edge at a time when both exist. Walking both edges back in time
   (the younger part is undone first) meets every two parts that coexist; the
   pair holds if none of them has a merge early enough. A sequence whose pairs
   all hold, of tokens that encode to themselves, is the encoding.
3. *Repair.* Only words with a failing pair are merged exactly, lowest rank
   first; words of like length side by side, one merge each at a time.

The rule of step 2 needs every entry to be made by one merge of older entries;
that is checked when a file is read, and where it does not hold all words take
step 3. Words come from the file's own normaliser and pre-tokeniser, and are
kept per piece of text (see ``chunk_cache``), as pieces repeat.

Decoding joins the tokens of the ids by one space, which is what the library
does for a file without a decoder.

Defined results: null and empty texts have no ids and decode to an empty
text; special tokens in a text are one id each; repeated rows are encoded
alike; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunk_cache import Encoder, Known, byte_chars, together, token_file, word_pieces
from .common import documents, map_arrow, remembered, slices

END = "￿"  # stands for the end-of-word suffix, so that it is one character
LONG = 48  # symbols; longer words are cut and merged one by one
ROWS = 8192  # words side by side
_NEVER = np.int64(1 << 40)
_LAST = np.int64(1 << 60)


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.encoder = Encoder(path)
        self.lib = self.encoder.lib
        self.vocab = {self._one(t): i for t, i in model["vocab"].items()}
        self.longest = max(map(len, self.vocab), default=0)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.named = {i: (f"{i} ".encode(), f"{t} ".encode()) for i, t in self.token.items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special))) + ")") if self.special else None
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        parts = [(self._one(a), self._one(b)) for a, b in merges]
        self.rank = {p: r for r, p in enumerate(parts)}
        self._edges(parts)
        self.known = Known(self._entries)  # of a piece: its ids and its tokens, a space after each
        self.pattern = self._split_pattern(spec)
        self.byte_char = {chr(b): c for b, c in enumerate(byte_chars())}

    def _split_pattern(self, spec: dict):
        """The file's split pattern, for chunks within ``SAFE``; None if the
        file's pre-tokeniser is not one split that keeps the matches and then
        maps bytes."""
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        kinds = [s.get("type") for s in steps]
        if kinds != ["Split", "ByteLevel"] or steps[0].get("behavior") != "Removed" or not steps[0].get("invert"):
            return None
        if steps[1].get("use_regex") or steps[1].get("add_prefix_space"):
            return None
        return regex.compile(steps[0]["pattern"]["Regex"]).findall

    def _safe_words(self, piece: str) -> list[str]:
        """Words of a lower-cased piece within ``SAFE``."""
        found = [piece] if piece.isalpha() else self.pattern(piece)
        if piece.isascii() and piece.isprintable():
            return found
        get = self.byte_char.__getitem__
        return [w if w.isascii() and w.isprintable() else "".join(map(get, w.encode().decode("latin-1"))) for w in found]

    def _one(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix):
            return token[:-len(self.suffix)] + END
        return token

    def _edges(self, parts: list[tuple[str, str]]) -> None:
        """For each id: rank of the merge that makes it (-1: a single
        character) and the ids of its halves; merges as sorted pair keys."""
        n = max(self.vocab.values(), default=0) + 1
        self.made = np.full(n, -1, np.int64)
        self.left = np.arange(n)
        self.right = np.arange(n)
        keys, ranks, sound = [], [], len(set(self.vocab)) == len(self.vocab)
        for r, (a, b) in enumerate(parts):
            whole = self.vocab.get(a + b)
            x, y = self.vocab.get(a), self.vocab.get(b)
            if whole is None or x is None or y is None or self.made[whole] >= 0 or max(self.made[x], self.made[y]) >= r:
                sound = False
                continue
            self.made[whole], self.left[whole], self.right[whole] = r, x, y
            keys.append(x * n + y)
            ranks.append(r)
        # pair to rank and id of its merge, as one number
        self.next = {k: r * n + self.vocab[parts[r][0] + parts[r][1]] for k, r in zip(keys, ranks)}
        self.reach: dict[str, int] = {}  # longest entry that starts with these three characters
        for t in self.vocab:
            self.reach[t[:3]] = max(self.reach.get(t[:3], 0), len(t))
        order = np.argsort(keys)
        self.pair_key = np.array(keys, np.int64)[order]
        self.pair_rank = np.array(ranks, np.int64)[order]
        self.pair_next = np.array([self.next[k] for k in keys], np.int64)[order]
        loose = [t for t, i in self.vocab.items() if len(t.replace(END, "") or t) > 1 and self.made[i] < 0]
        self.sound, self.size = sound and not loose and len(keys) > 0, n
        # ids of single characters, inside a word and at its end
        top = max((ord(t[0]) for t in self.vocab if len(t.replace(END, "")) == 1), default=0) + 2
        self.inner, self.final = np.full(top, -1), np.full(top, -1)
        for t, i in self.vocab.items():
            if len(t) == 1 and t != END:
                self.inner[ord(t)] = i
                if not self.suffix:
                    self.final[ord(t)] = i
            elif len(t) == 2 and t[1] == END:
                self.final[ord(t[0])] = i
        if self.sound:
            self._trie()

    def _trie(self) -> None:
        """Nodes of all beginnings of entries, as ids of single characters;
        the node of a single character is that character's id."""
        step: dict[int, int] = {}
        n, nodes, entry = self.size, self.size, {}
        for t, i in self.vocab.items():
            own = list(t)
            if len(own) > 1 and own[-1] == END:
                own[-2:] = [own[-2] + END]
            if any(c not in self.vocab for c in own):
                continue
            at = self.vocab[own[0]]
            for c in own[1:]:
                key = at * n + self.vocab[c]
                if key not in step:
                    step[key] = nodes
                    nodes += 1
                at = step[key]
            entry[at] = i
        self.step_key = np.array(sorted(step), np.int64)
        self.step_node = np.array([step[k] for k in sorted(step)], np.int64)
        self.entry = np.full(nodes, -1)
        self.entry[list(entry)] = list(entry.values())

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens stays two tokens."""
        good = np.ones(len(a), bool)
        at = np.arange(len(a))
        x, y = a.copy(), b.copy()
        gone_x = np.full(len(a), _NEVER)  # rank of the merge that uses up the part
        gone_y = np.full(len(a), _NEVER)
        while len(at):
            r = self._pair_rank(x, y)
            # of two equal merges the one further left goes first
            joins = (r < gone_x) & (r <= gone_y) & (r < _NEVER)
            good[at[joins]] = False
            younger_x = self.made[x] > self.made[y]
            # a part on the left edge that was made by the same merge as one on
            # the right edge is older, as it lies further left
            live = ~joins & (np.maximum(self.made[x], self.made[y]) >= 0)
            at, x, y = at[live], x[live], y[live]
            gone_x, gone_y, younger_x = gone_x[live], gone_y[live], younger_x[live]
            gone_x = np.where(younger_x, self.made[x], gone_x)
            gone_y = np.where(younger_x, gone_y, self.made[y])
            x, y = np.where(younger_x, self.right[x], x), np.where(younger_x, y, self.left[y])
        return good

    def propose(self, word: str) -> list[int] | None:
        out, i, n = [], 0, len(word)
        vocab, reach = self.vocab.get, self.reach.get
        last = n - 1 if word.endswith(END) else n + 1  # no token ends right before the suffix
        while i < n:
            for j in range(min(n, i + reach(word[i:i + 3], 2)), i, -1):
                t = vocab(word[i:j])
                if t is not None and j != last:
                    out.append(t)
                    i = j
                    break
            else:
                return None
        return out

    def merge(self, word: str) -> list[int]:
        """Exact merging, lowest rank first and leftmost among equals."""
        parts = list(word)
        if len(parts) > 1 and parts[-1] == END:
            parts[-2:] = [parts[-2] + END]
        ids = [self.vocab[p] for p in parts if p in self.vocab]
        if not self.sound:
            return self._merge_strings(parts)
        n, get, none = self.size, self.next.get, 1 << 60
        made = [get(a * n + b, none) for a, b in zip(ids, ids[1:])]
        while made:
            least = min(made)
            if least == none:
                break
            i = made.index(least)
            ids[i:i + 2] = [least % n]
            del made[i]
            if i:
                made[i - 1] = get(ids[i - 1] * n + ids[i], none)
            if i < len(made):
                made[i] = get(ids[i] * n + ids[i + 1], none)
        return ids

    def _merge_strings(self, parts: list[str]) -> list[int]:
        while len(parts) > 1:
            rank, i = min((self.rank.get(p, _NEVER), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == _NEVER:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.vocab[p] for p in parts if p in self.vocab]

    def _propose_all(self, symbols: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest entries first, for rows of symbols (-1: past the end);
        entries and their number."""
        out, counts = np.full(symbols.shape, -1), np.zeros(len(symbols), np.int64)
        row, last, n = np.arange(len(symbols)), symbols.shape[1] - 1, len(self.step_key) - 1
        pos = np.ones(len(row), np.int64)
        node = symbols[:, 0].copy()
        best, end = node.copy(), pos.copy()
        while len(row):
            c = np.where(pos < lens[row], symbols[row, np.minimum(pos, last)], -1)
            key = node * self.size + c
            at = np.minimum(np.searchsorted(self.step_key, key), n)
            on = (c >= 0) & (self.step_key[at] == key)
            pos += on
            node = np.where(on, self.step_node[at], node)
            made = self.entry[node]
            longer = on & (made >= 0)
            best, end = np.where(longer, made, best), np.where(longer, pos, end)
            off = np.flatnonzero(~on)
            r = row[off]
            out[r, counts[r]] = best[off]
            counts[r] += 1
            begin = end[off]
            over = begin >= lens[r]
            node[off] = best[off] = symbols[r, np.minimum(begin, last)]
            pos[off] = end[off] = begin + 1
            if over.any():
                live = np.ones(len(row), bool)
                live[off[over]] = False
                row, pos, node, best, end = row[live], pos[live], node[live], best[live], end[live]
        return out, counts

    def _next(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank and id of the merge of each pair as one number."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where((self.pair_key[at] == key) & (a >= 0) & (b >= 0), self.pair_next[at], _LAST)

    def _merge_all(self, symbols: np.ndarray) -> np.ndarray:
        """Exact merging of rows of symbols (-1: past the end)."""
        out = np.full(symbols.shape, -1)
        ids = np.column_stack([symbols, np.full(len(symbols), -1)])
        pairs = np.column_stack([self._next(ids[:, :-1], ids[:, 1:]), np.full(len(ids), _LAST)])
        row, cols = np.arange(len(ids)), np.arange(ids.shape[1])
        while len(row):
            j = pairs.argmin(1)
            least = pairs[np.arange(len(row)), j]
            done = least == _LAST
            if done.any():
                out[row[done]] = ids[done, :-1]
                live = ~done
                row, ids, pairs, j, least = row[live], ids[live], pairs[live], j[live], least[live]
                if not len(row):
                    break
            shift = np.minimum(cols + (cols > j[:, None]), len(cols) - 1)
            ids, pairs = np.take_along_axis(ids, shift, 1), np.take_along_axis(pairs, shift, 1)
            at, whole = np.arange(len(row)), least % self.size
            ids[at, j] = whole
            pairs[at, j] = self._next(whole, ids[at, j + 1])
            inner = np.flatnonzero(j)
            pairs[inner, j[inner] - 1] = self._next(ids[inner, j[inner] - 1], whole[inner])
        return out

    def _holds(self, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """For each proposal, whether every pair of its tokens holds."""
        good = np.ones(len(counts), bool)
        if len(flat) > 1:
            owner = np.repeat(np.arange(len(counts)), counts)
            inner = owner[1:] == owner[:-1]
            holds = self.compatible(flat[:-1][inner], flat[1:][inner])
            good[owner[1:][inner][~holds]] = False
        return good

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word (characters of the pre-tokeniser, without suffix)."""
        lens = np.array([len(w) for w in words], np.int64)
        out: list = [None] * len(words)
        char = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        char = np.minimum(char, len(self.inner) - 1)  # the last one is no character's
        first = np.cumsum(lens) - lens
        symbol = self.inner[char]
        some = lens > 0
        symbol[(first + lens - 1)[some]] = self.final[char[(first + lens - 1)[some]]]
        strange = np.concatenate([[0], np.cumsum(symbol < 0)])
        usual = some & (lens <= LONG) & (strange[first + lens] == strange[first]) & self.sound
        order = np.flatnonzero(usual)
        order = order[np.argsort(lens[order], kind="stable")]
        for a in range(0, len(order), ROWS):
            own = order[a:a + ROWS]
            n = lens[own]
            cols = np.arange(n.max())
            inside = cols < n[:, None]
            rows = np.where(inside, symbol[np.where(inside, first[own][:, None] + cols, 0)], -1)
            ids, counts = self._propose_all(rows, n)
            bad = ~self._holds(ids[ids >= 0], counts)
            ids[bad] = self._merge_all(rows[bad])
            counts = (ids >= 0).sum(1)
            flat, at = ids[ids >= 0].tolist(), np.concatenate([[0], np.cumsum(counts)]).tolist()
            for w, x, y in zip(own.tolist(), at, at[1:]):
                out[w] = flat[x:y]
        for i in np.flatnonzero(~usual).tolist():
            out[i] = self._alone(words[i] + END if self.suffix else words[i])
        return out

    def _alone(self, word: str) -> list[int]:
        found = self.propose(word) if self.sound else None
        if found is not None and self._holds(np.array(found, np.int64), np.array([len(found)])).all():
            return found
        return self.merge(word)

    def _words(self, text: str) -> list[str]:
        if self.lib.normalizer is not None:
            text = self.lib.normalizer.normalize_str(text)
        return [w for w, _ in self.lib.pre_tokenizer.pre_tokenize_str(text)]

    def _pieces(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.split_special.split(text) if self.split_special else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                for ids in self.encode_words(self._words(part)):
                    out += ids
        return out

    def _entries(self, pieces: list[str]) -> list[tuple[bytes, bytes]]:
        words = [self._safe_words(p) for p in pieces]
        new = list({w for ws in words for w in ws})
        made = dict(zip(new, self.encode_words(new)))
        name, out = self.named, []
        for ws in words:
            own = [name[i] for w in ws for i in made[w]]
            out.append((b"".join([x for x, _ in own]), b"".join([y for _, y in own])))
        return out

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.token[i] for i in ids])

    def encode(self, text: str | None) -> list[int]:
        return self._pieces(text) if text else []

    def digests(self, texts: list[str | None]) -> tuple[list[int], list[str], list[str]]:
        """Per text: number of ids, sha256 of the ids, sha256 of the decoded text."""
        made = [(b"", b"")] * len(texts)
        easy = [i for i, t in enumerate(texts) if self.pattern and self.encoder.words and self.encoder.easy(t)]
        if easy:  # every piece has a token, as the pattern keeps all but space
            pieces, bounds = word_pieces([texts[i] for i in easy])
            entries = self.known.of(pieces.dictionary.to_pylist())
            both = [together([e[k] for e in entries], pieces, bounds) for k in (0, 1)]
            for i, x, y in zip(easy, *both):
                made[i] = x[:-1], y[:-1]
        for i in set(range(len(texts))).difference(easy):
            own = self.encode(texts[i])
            made[i] = " ".join(map(str, own)).encode(), self.decode(own).encode()
        return ([x.count(b" ") + 1 if x else 0 for x, _ in made],
                *([hashlib.sha256(m[k]).hexdigest() for m in made] for k in (0, 1)))


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


remembered("codec", codec)


def encode(df: DataFrame, text: str, path: str, *keep: str) -> DataFrame:
    """``keep`` columns, ``ids`` (array of int) and ``decoded``, row by row."""
    src = df.select(*keep, F.col(text).alias("_text"))

    def run(batch: pa.RecordBatch):
        c = codec(path)
        for part in slices(batch, batch.num_columns - 1):
            ids = [c.encode(t) for t in part.column(part.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(ids, pa.list_(pa.int32())), pa.array([c.decode(i) for i in ids])],
                names=[*part.schema.names[:-1], "ids", "decoded"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.drop("_text").schema)
    return map_arrow(src, run, f"{kept.rstrip(', ')}, ids array<int>, decoded string".lstrip(", "), "codec")


def digests(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    src = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch):
        c = codec(path)
        for part in slices(batch, "text"):
            n, a, b = c.digests(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return map_arrow(src, run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", "codec")


def op6_bpe(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    return digests(documents(spark, sf_dir), "doc_id", "text", tokenizer or token_file("word_bpe_49k.json"))
