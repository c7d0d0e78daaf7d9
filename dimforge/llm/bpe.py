"""BPE encoding and decoding by traversal of a prefix-sharing trie.

The tokens of a text are those of its words, so every distinct word of a
task is encoded once.  The distinct words, as symbol strings whose last
symbol carries the end-of-word mark, form a trie.  Each trie node stands for
a prefix and is given the *last token* of that prefix's encoding; the
encoding of a node is its last token after the encoding of the node that
the token leads back to.  A depth-first walk over the words in sorted order
computes the state of a shared prefix once.

The last token of a prefix is its longest suffix ``t`` in the vocabulary
such that ``t`` may follow the last token of what precedes it: two tokens may
stand side by side exactly when merging the symbols of both gives these two
tokens back.  That test runs the merge rules on a token pair and is kept in
a table.

Documents are independent: one narrow stage, no shuffle.  The tables of a
task (words and token pairs) are cleared when they reach a fixed number of
entries, which only costs time.

Defined results
  * null or empty text: no tokens, decoded text empty;
  * literal special tokens in a text get their ids, as in the tokenizers library;
  * characters outside the vocabulary cannot occur (all 256 byte symbols are in it);
  * null ids, repeated rows: each row is encoded on its own, ids pass through;
  * empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import sys
import types
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm._common import bounded_batches, read

MAX_WORDS = 300_000
NO_RANK = 1 << 30
MAX_PAIRS = 500_000
OUT_BYTES = 1 << 20  # of ids in a batch of results


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1
    characters stand for themselves, the rest get code points from 256 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = [""] * 256
    for b in keep:
        out[b] = chr(b)
    for n, b in enumerate(b for b in range(256) if not out[b]):
        out[b] = chr(256 + n)
    return out


class WordBpe:
    """Vocabulary, merge ranks and word pattern of a tokenizers file of kind
    BPE with an end-of-word suffix and byte symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.token = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token.update({i: t for t, i in self.special.items()})
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        # token -> (rank, left part, right part) of the merge that makes it; pair -> rank
        self.made: dict[int, tuple[int, int, int]] = {}
        self.join: dict[tuple[int, int], int] = {}
        rank = {tuple(m if isinstance(m, list) else m.split(" ")): r for r, m in enumerate(model["merges"])}
        for (x, y), r in rank.items():
            pair = self.vocab[x], self.vocab[y]
            self.join[pair] = r
            self.made.setdefault(self.vocab[x + y], (r, *pair))
        self.rare = regex.compile("[^\x00-\u052f]")
        self.symbol = str.maketrans(dict(enumerate(byte_symbols())))
        # a token as stored by its symbols: (plain text, whether it ends a word)
        self.mid = {t: i for t, i in self.vocab.items() if not t.endswith(self.end)}
        self.last = {t[: -len(self.end)]: i for t, i in self.vocab.items() if t.endswith(self.end) and t != self.end}
        self.lens = {i: len(t) for t, i in [*self.mid.items(), *self.last.items()]}
        self.longest = max(map(len, self.mid), default=1)
        self.longest_last = max(map(len, self.last), default=1)
        self.pairs: dict[int, bool] = {}  # by a << 32 | b: a number takes half a tuple's room

    # -- text to words -------------------------------------------------
    def words(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        t = unicodedata.normalize("NFC", text)
        if "Σ" in t:  # lower case letter by letter: no final sigma
            t = t.replace("Σ", "σ")
        t = t.lower()
        if self.rare.search(t) is None:
            return self.word.findall(t)
        # code points that no Unicode version of this Python knows are neither letters nor numbers
        known = "".join("\ue000" if c > "\u052f" and unicodedata.category(c) == "Cn" else c for c in t)
        return [t[m.start():m.end()] for m in self.word.finditer(known)]

    def pieces(self, text: str) -> Iterator[str | int]:
        """Words, and the ids of special tokens between them."""
        if self.cut is None or "<|" not in text and not self.cut.search(text):
            yield from self.words(text)
            return
        at = 0
        for m in self.cut.finditer(text):
            yield from self.words(text[at:m.start()])
            yield self.special[m.group()]
            at = m.end()
        yield from self.words(text[at:])

    def _rank(self, pair: tuple[str, str]) -> int:
        return self.join.get((self.vocab.get(pair[0]), self.vocab.get(pair[1])), NO_RANK)

    # -- merge rules on a token pair -------------------------------------
    def merge(self, symbols: list[str]) -> list[str]:
        """The merge rules applied to symbols, as defined."""
        while len(symbols) > 1:
            best = min(zip(symbols, symbols[1:]), key=self._rank)
            if self._rank(best) == NO_RANK:
                break
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == best:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def _symbols(self, token: int) -> list[str]:
        t = self.token[token]
        if t.endswith(self.end) and t != self.end:
            body = t[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(t)

    def side_by_side(self, a: int, b: int) -> bool:
        """Whether token b may follow token a (a = -1: b starts the word).

        Both tokens are undone merge by merge, the latest first, while the
        symbols that touch are looked at: the pair fails if those two would
        have merged before the undone merge took one of them."""
        if a < 0:
            ok = self.merge(self._symbols(b)) == [self.token[b]]
        else:
            ok = self._may_touch(a, b)
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        self.pairs[a << 32 | b] = ok
        return ok

    def _may_touch(self, a: int, b: int) -> bool:
        made, join = self.made, self.join
        before = 1 << 30  # the touching parts existed side by side until this rank
        while True:
            if join.get((a, b), 1 << 30) < before:
                return False
            ra, rb = made.get(a), made.get(b)
            if ra is None and rb is None:
                return True
            # of two equal merges the left one is done first
            if rb is None or (ra is not None and ra[0] > rb[0]):
                before, a = ra[0], ra[2]
            else:
                before, b = rb[0] + 1, rb[1]

    # -- trie walk -------------------------------------------------------
    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """(word, ids) of distinct words, walking their trie depth first."""
        spelled = sorted((w if w.isascii() and w.isprintable() else w.encode("utf-8").decode("latin-1").translate(self.symbol), w) for w in words)
        mid, last, lens, known, test = self.mid.get, self.last.get, self.lens, self.pairs.get, self.side_by_side
        longest, longest_last = self.longest, self.longest_last
        path, states = "", [-1]  # the prefix walked to, and the last token at each of its nodes
        for s, word in spelled:
            n = len(s)
            body = n - 1
            if not s.startswith(path):
                shared, most = 0, min(len(path), body)
                while shared < most and path[shared] == s[shared]:
                    shared += 1
                del states[shared + 1:]
            else:
                del states[body + 1:]
            for i in range(len(states), body + 1):
                for k in range(i - longest if i > longest else 0, i):
                    t = mid(s[k:i])
                    if t is not None:
                        ok = known(states[k] << 32 | t)
                        if ok or (ok is None and test(states[k], t)):
                            states.append(t)
                            break
            path = s[:body]
            for k in range(n - longest_last if n > longest_last else 0, n):
                t = last(s[k:])
                if t is not None:
                    ok = known(states[k] << 32 | t)
                    if ok or (ok is None and test(states[k], t)):
                        break
            ids, at = [t], n - lens[t]
            while at:
                t = states[at]
                ids.append(t)
                at -= lens[t]
            ids.reverse()
            yield word, ids


def load(path: str) -> WordBpe:
    """The tokenizer at ``path``, read once per Python process (functions reach
    the workers by value, so the place to keep it is the interpreter)."""
    kept = sys.modules.setdefault("_dimforge_tokenizers", types.ModuleType("_dimforge_tokenizers")).__dict__
    if path not in kept:
        kept[path] = WordBpe(path)
    return kept[path]


class Coder:
    """Encodes texts with a bounded table of words already encoded."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.ids: dict[str | int, bytes] = {}

    def learn(self, words: set[str | int]) -> None:
        new = [w for w in words if w not in self.ids]
        if len(self.ids) + len(new) > MAX_WORDS:
            self.ids.clear()
            new = list(words)
        for w in new:
            if isinstance(w, int):
                self.put(w, [w])
        for w, ids in self.bpe.encode_words(w for w in new if isinstance(w, str)):
            self.put(w, ids)

    def put(self, word: str | int, ids: list[int]) -> None:
        self.ids[word] = array("I", ids).tobytes()

    def code(self, texts: list[str | None]) -> Iterator[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each text."""
        block: list[list[str | int]] = []
        size = 0
        for t in texts:
            p = list(self.bpe.pieces(t or ""))
            block.append(p)
            size += len(p)
            if size >= MAX_WORDS // 3:
                yield from self._flush(block)
                block, size = [], 0
        yield from self._flush(block)

    def _flush(self, block: list[list[str | int]]) -> Iterator[tuple[bytes, str]]:
        self.learn({w for p in block for w in p})
        ids, token = self.ids.__getitem__, self.bpe.token.__getitem__
        for p in block:
            found = b"".join(map(ids, p))
            yield found, " ".join(map(token, array("I", found)))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           digest: bool = False) -> DataFrame:
    """doc_id, n_tokens and, per document, either ids (array<int>) and decoded
    text, or their SHA-256 digests."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n_tokens long, " + (
        "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string")

    names = [f.split(" ")[0] for f in schema.split(", ")]

    def result(ids: pa.Array, out: list) -> pa.RecordBatch:
        if digest:
            n = [k for *_, k in out]
            cols = [pa.array([i for i, *_ in out], pa.string()), pa.array([d for _, d, _ in out], pa.string())]
        else:
            n = [len(i) // 4 for i, _ in out]
            off = np.cumsum([0, *n]).astype(np.int32)
            flat = pa.Array.from_buffers(pa.int32(), int(off[-1]), [None, pa.py_buffer(b"".join(i for i, _ in out))])
            cols = [pa.ListArray.from_arrays(pa.array(off), flat), pa.array([d for _, d in out], pa.string())]
        return pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(n, pa.int64()), *cols], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(load(path))
        for b in batches:
            out: list = []
            at = size = 0
            for found in coder.code(b.column(1).to_pylist()):
                out.append((hashlib.sha256(found[0]).hexdigest(), hashlib.sha256(found[1].encode("utf-8")).hexdigest(), len(found[0]) // 4) if digest else found)
                size += len(found[0])
                if size >= OUT_BYTES:
                    yield result(b.column(0).slice(at, len(out)), out)
                    at, out, size = at + len(out), [], 0
            yield result(b.column(0).slice(at, len(out)), out)

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text of each array of ids (null: empty): the tokens' strings joined by spaces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = load(path).token
        for b in batches:
            text = [" ".join(token[i] for i in ids or () if i in token) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(text, pa.string())], ["doc_id", "decoded"])

    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, decoded string")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op8_bpe(spark, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "documents"), tokenizer_path(), digest=True)
