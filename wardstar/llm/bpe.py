"""BPE encoding and decoding by speculation and verification.

For every distinct word a greedy longest match proposes tokens. A proposal is
the true BPE result exactly if each token encodes to itself and every pair of
neighbours is compatible, that is, no merge over the boundary would have come
before the merges that built the two tokens. All pairs of a batch are tested
at once: the pair is taken apart again, last merge first, as arrays, and at
every step a merge over the boundary is looked up. Only words with a failing
pair go through the exact merge loop.

Works for tokenizer files whose model is BPE over byte characters, with or
without an end-of-word suffix, with a ``Split`` or ``ByteLevel`` pre-tokenizer
and an NFC / white space / lower-case normalizer or none.

Defined cases: a null text is encoded as the empty text (no ids, decoded to
the empty string); truncation and padding of the file are not applied;
repeated rows are encoded one by one; texts and words of any length are encoded
whole; the rows of an empty table are none;
columns that clash with ``ids``, ``n_tokens`` or ``decoded`` are replaced.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_text_columns, others, quoted
from .pieces import PieceTable

# A worker forgets its encoded chunks and words beyond so many.
CACHE_CHUNKS = 150_000
CACHE_WORDS = 250_000
# Longer words are merged with a heap.
LONG_WORD = 200
# Characters up to this one have had the same Unicode classes for long; words
# with later ones are cut by the library, whose Unicode tables may be older.
PLAIN = "\u024f"
# About so many ids are decoded to one Arrow batch.
DECODE_IDS = 1 << 20
SPECIAL = "\0"
EMPTY = np.empty(0, np.int32)
# Its lower case is two characters, the second no letter.
DOTTED = "\u0130"
# Words verified together.
BLOCK_WORDS = 50_000
# Fixed value: the byte-level pre-tokenizer's own pattern.
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                      r"|\s+(?!\S)|\s+")

_CODECS: dict[str, "Codec"] = {}


def byte_characters() -> dict[int, str]:
    """Byte to the printable character that stands for it in the vocabulary:
    printable Latin-1 bytes stand for themselves, the others are numbered from
    256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return out


class Codec:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or \
                model.get("byte_fallback") or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("a plain BPE model over byte characters is expected")
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self._read_merges([m.split(" ") if isinstance(m, str) else m for m in model["merges"]])
        self._read_pipeline(spec)
        special = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        if any(a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"]
               for a in spec.get("added_tokens", [])):
            raise ValueError("added tokens are expected to be matched as they are")
        self.special = special
        self.cut_special = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") \
            if special else None
        self.tokens = token_strings(spec)
        size = len(self.tokens)
        chars = byte_characters()
        self.to_chars = bytes(range(256)).decode("latin-1").translate(chars)
        self.as_chars = {b: c for b, c in enumerate(self.to_chars)}
        self.to_byte = {c: b for b, c in chars.items()}
        self.longest = max(map(len, self.vocab))
        self.self_ok = np.zeros(size, np.int8)  # 1: encodes to itself, -1: does not
        self.has_rare = regex.compile(f"[^\0-{PLAIN}]|{DOTTED}").search
        self.library = Tokenizer.from_file(path)  # its normalizer and pre-tokenizer
        self.table = PieceTable(self._learn, np.dtype("<u4"), CACHE_CHUNKS)
        self.word_table = PieceTable(self._learn_words, np.dtype("<u4"), CACHE_WORDS)
        self.n_words = self.n_exact = 0

    def _read_merges(self, merges: Sequence[Sequence[str]]) -> None:
        v = self.vocab
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        size = max(v.values()) + 1
        self.left, self.right = np.full(size, -1), np.full(size, -1)
        self.made_at = np.full(size, -1)  # rank of the merge that makes a token
        for k, (a, b) in enumerate(merges):
            pair, made = (v[a], v[b]), v[a + b]
            if self.made_at[made] >= 0 or pair in self.rank:
                raise ValueError("a token that two merges make can't be verified by pairs")
            self.rank[pair] = k
            self.made.append(made)
            self.left[made], self.right[made], self.made_at[made] = *pair, k
        keys = np.fromiter((a << 32 | b for a, b in self.rank), np.int64, len(self.rank))
        order = np.argsort(keys)
        self.keys, self.key_rank = keys[order], order  # merges were read in rank order

    def _read_pipeline(self, spec: dict) -> None:
        norm = spec.get("normalizer")
        steps = [] if not norm else norm.get("normalizers", [norm])
        kinds = [s["type"] for s in steps]
        if kinds not in ([], ["NFC", "Replace", "Lowercase"]) or any(
                s["type"] == "Replace" and (s["pattern"], s["content"]) != ({"Regex": "\\s+"}, " ")
                for s in steps):
            raise ValueError(f"unknown normalizer: {kinds}")
        self.normalizes = bool(kinds)
        pre = spec["pre_tokenizer"]
        pres = pre.get("pretokenizers", [pre])
        if any(p.get("add_prefix_space") for p in pres):
            raise ValueError("a prefix space is not supported")
        if [p["type"] for p in pres] == ["ByteLevel"]:
            pattern, self.drops_rest = BYTE_LEVEL_PATTERN, False
        elif [p["type"] for p in pres] == ["Split", "ByteLevel"] and pres[0]["invert"] and \
                pres[0]["behavior"] == "Removed" and not pres[1]["use_regex"]:
            pattern, self.drops_rest = pres[0]["pattern"]["Regex"], True
        else:
            raise ValueError("unknown pre-tokenizer")
        self.words = regex.compile(pattern, regex.V0).findall

    # ------------------------------------------------------------ words
    def _cut(self, text: str) -> list[str]:
        """The words of a text, as the vocabulary's byte characters."""
        if self.has_rare(text):
            if self.normalizes:
                text = self.library.normalizer.normalize_str(text)
            return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        if self.normalizes:
            # up to U+024F a text is in NFC, and lower case needs no context
            text = text.lower() if text.isascii() else regex.sub(r"\s+", " ", text).lower()
        return list(map(self._symbols, self.words(text)))

    def _symbols(self, word: str) -> str:
        """The word's bytes as vocabulary characters."""
        if word.isascii() and word.isprintable() and " " not in word:
            return word
        return word.encode("utf-8").decode("latin-1").translate(self.as_chars)

    def propose(self, s: str) -> list[int]:
        """Greedy longest match over the byte characters of one word."""
        get, end, n, i, out = self.vocab.get, self.end, len(s), 0, []
        last = get(s + end)
        if last is not None:
            return [last]
        while i < n:
            j = min(n, i + self.longest)
            if j == n:
                t = get(s[i:] + end)
                if t is not None:
                    out.append(t)
                    break
                j -= bool(end)
            while (t := get(s[i:j])) is None:
                j -= 1
            out.append(t)
            i = j
        return out

    def merge(self, symbols: list[int]) -> list[int]:
        """The exact merge loop: lowest rank first, from the left."""
        if len(symbols) > LONG_WORD:
            return self._merge_long(symbols)
        ids, get, none = list(symbols), self.rank.get, len(self.made)
        ranks = [get(p, none) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            ids[i:i + 2] = [self.made[best]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), none)
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), none)
        return ids

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same with a heap over a linked list, for long words."""
        ids, get = list(symbols), self.rank.get
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(k, i, p) for i, p in enumerate(zip(ids, ids[1:])) if (k := get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            k, i, pair = heapq.heappop(heap)
            j = after[i]
            if j < 0 or (ids[i], ids[j]) != pair:
                continue  # one of the two has been merged since
            ids[i], ids[j] = self.made[k], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            after[j] = -1
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r, x, (ids[x], ids[y])))
        return [t for t in ids if t >= 0]

    def exact(self, s: str) -> list[int]:
        if not s:
            return []
        return self.merge([self.vocab[c] for c in s[:-1]] + [self.vocab[s[-1] + self.end]])

    def _base(self, token: int) -> list[int]:
        """The symbols that a token's merges start from."""
        out, todo = [], [token]
        while todo:
            t = todo.pop()
            if self.made_at[t] < 0:
                out.append(t)
            else:
                todo += [int(self.right[t]), int(self.left[t])]
        return out

    def _check_tokens(self, ids: np.ndarray) -> None:
        for t in np.unique(ids[self.self_ok[ids] == 0]).tolist():
            self.self_ok[t] = 1 if self.merge(self._base(t)) == [t] else -1

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of neighbouring tokens: may both stand side by side?"""
        ok = np.ones(len(a), bool)
        limit = np.full(len(a), np.iinfo(np.int64).max)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        while len(live):
            key = a << 32 | b
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            crossed = (self.keys[at] == key) & (self.key_rank[at] < limit)
            ok[live[crossed]] = False
            # undo the later of the two last merges; of equal ones the right one
            ra, rb = self.made_at[a], self.made_at[b]
            undo_left = ra > rb
            more = ~crossed & (np.maximum(ra, rb) >= 0)
            # a crossing merge of the same rank comes first only on the left side
            limit = np.where(undo_left, ra, rb + 1)[more]
            a, b, undo_left, live = a[more], b[more], undo_left[more], live[more]
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
        return ok

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of distinct words given as byte characters."""
        out: list[list[int]] = []
        for lo in range(0, len(words), BLOCK_WORDS):
            part = words[lo:lo + BLOCK_WORDS]
            found = [self.propose(w) for w in part]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((t for f in found for t in f), np.int64, int(sizes.sum()))
            word_of = np.repeat(np.arange(len(part)), sizes)
            self._check_tokens(flat)
            bad = np.zeros(len(part), bool)
            bad[word_of[self.self_ok[flat] < 0]] = True
            inner = np.flatnonzero(word_of[1:] == word_of[:-1])
            pairs, where = np.unique(flat[inner] << 32 | flat[inner + 1], return_inverse=True)
            good = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)
            bad[word_of[inner[~good[where]]]] = True
            for i in np.flatnonzero(bad).tolist():
                found[i] = self.exact(part[i])
            self.n_words += len(part)
            self.n_exact += int(bad.sum())
            out += found
        return out

    # ------------------------------------------------------------ texts
    def _words_of(self, chunk: str) -> list[str]:
        """The words of a chunk as byte characters; a special token is a word
        of its own, marked by a character that is no byte character."""
        core, mark = (chunk[:-1], chunk[-1:]) if chunk[-1] in ",." else (chunk, "")
        if self.drops_rest and core.isalpha() and (core.isascii() or not self.has_rare(core)):
            word = self._symbols(core.lower() if self.normalizes else core)
            return [word, mark] if mark else [word]
        parts = [chunk] if self.cut_special is None else self.cut_special.split(chunk)
        return [w for p in parts if p for w in ([SPECIAL + p] if p in self.special else self._cut(p))]

    def _learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new chunks, by way of their words."""
        if len(self.word_table) > self.word_table.limit:
            self.word_table.clear()
        words = [self._words_of(c) for c in chunks]
        n = np.fromiter(map(len, words), np.int64, len(words))
        ids, sizes = self.word_table.lookup(chain.from_iterable(words), int(n.sum()))
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[np.cumsum(n)]
        return ids, np.diff(ends, prepend=0)

    def _learn_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        special = [w[0] == SPECIAL for w in words]
        found = iter(self.encode_words([w for w, s in zip(words, special) if not s]))
        rows = [[self.special[w[1:]]] if s else next(found) for w, s in zip(words, special)]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        return np.fromiter(chain.from_iterable(rows), np.uint32, int(sizes.sum())), sizes

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        return self.table.encode([self._chunks(t) if t else [] for t in texts])

    def _chunks(self, text: str) -> list[str]:
        """Parts that no word reaches over. If white space is dropped, a text
        is cut at blanks and line ends; else it stays whole. Where lower case
        can make no special token, it is made first: fewer chunks differ."""
        if not self.drops_rest:
            return [text]
        if self.normalizes and (text.isascii() or not self.has_rare(text)):
            low = text.lower()
            if not any(s.lower() in low for s in self.special):
                text = low
        return [c for c in text.replace("\n", " ").split(" ") if c]

def token_strings(spec: dict) -> list[str]:
    """Token strings by id."""
    known = {**spec["model"]["vocab"], **{a["content"]: a["id"] for a in spec.get("added_tokens", [])}}
    out = [""] * (max(known.values()) + 1)
    for token, i in known.items():
        out[i] = token
    return out


def decode(tokens: list[str], ids: Sequence[int]) -> str:
    """Tokens joined by a blank, as for a file without a decoder."""
    return " ".join([tokens[i] for i in ids])


def codec(path: str) -> Codec:
    """The codec of this worker, kept between its tasks."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _ids_array(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                    pa.array(np.concatenate([EMPTY, *ids]).astype(np.int32)))


def encode_bpe(df: DataFrame, tokenizer: str, text_col: str = "text",
               keep: list[str] | None = None, packed: bool = False) -> DataFrame:
    """Append ``ids`` and ``n_tokens`` (long).

    ``ids`` is an array of int or, if ``packed``, a binary of little-endian
    unsigned 32-bit integers. ``tokenizer`` is the path of a tokenizer file
    that every machine has.
    """
    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType(), True)
    schema = T.StructType([T.StructField("ids", kind),
                           T.StructField("n_tokens", T.LongType(), False)])

    def make():
        c = codec(tokenizer)

        def run(texts):
            ids = c.encode(texts)
            return [[r.tobytes() for r in ids] if packed else _ids_array(ids), list(map(len, ids))]
        return run
    return add_text_columns(df, text_col, schema, make, keep)


def decode_bpe(df: DataFrame, tokenizer: str, ids_col: str = "ids",
               keep: list[str] | None = None) -> DataFrame:
    """Append ``decoded`` (string): the text that the ids, an array or packed,
    stand for. Null ids are decoded as none."""
    passed = others(df, ["decoded"]) if keep is None else keep
    src = df.select(*[F.col(quoted(c)) for c in passed], F.col(quoted(ids_col)).alias("__ids"))
    out = T.StructType([src.schema[c] for c in passed] + [T.StructField("decoded", T.StringType())])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(out)
        with open(tokenizer, encoding="utf-8") as f:
            spec = json.load(f)
        if spec.get("decoder"):
            raise ValueError("a file without a decoder is expected")
        tokens = token_strings(spec)
        for b in batches:
            col, lo = b.column(len(passed)), 0
            while lo < len(b):
                texts, size = [], 0
                while lo + len(texts) < len(b) and size < DECODE_IDS:
                    ids = col[lo + len(texts)]
                    ids = np.frombuffer(ids.as_py() or b"", "<u4") if pa.types.is_binary(col.type) \
                        else ids.values.to_numpy() if ids.is_valid else EMPTY
                    texts.append(decode(tokens, ids.tolist()))
                    size += len(ids)
                arrays = [b.column(i).slice(lo, len(texts)) for i in range(len(passed))]
                arrays = [a if a.type == schema.field(i).type else a.cast(schema.field(i).type)
                          for i, a in enumerate(arrays)]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(texts, schema.field(len(passed)).type)], schema=schema)
                lo += len(texts)
    return src.mapInArrow(run, out)
