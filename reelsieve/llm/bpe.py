"""BPE encoding and decoding with a tokenization automaton.

The merges are compiled one after another into a deterministic automaton over token labels. It starts as one state that
every symbol leads back to. The gadget of merge ``u v``: the state that ``u`` leads to is copied without its ``v`` arc,
``u`` leads to the copy from then on, and each state with a ``u`` arc gets a ``uv`` arc to where ``v`` led. A path spells
a word's tokens exactly if the merges give these tokens. The target of an arc depends on its label alone, so a state is
named by a label and the number of merges seen; copies share what they have in common, and an arc of the table is looked
up when a word first needs it and kept. Text is split before the merges, so a word's path is found once for each task's
memory of words; decoding emits the labels of the arcs.

Null text is empty: no tokens and an empty decoded text. Repeated rows are encoded each; other columns pass through.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: White space of the normalizer: what Unicode calls white space.
_SPACE = "\t-\r \x85\xa0  -     　"
_SPLIT = regex.compile(f"[{_SPACE}]+")
_ODD = regex.compile("[\x1c-\x1f]")
END = "</w>"


def byte_labels() -> list[str]:
    """The printable character that stands for each byte: itself where Latin-1 prints it, else the next from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, n = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else n))
        n += b not in plain
    return out


class Automaton:
    """Encodes words of symbols; labels are numbered by the vocabulary."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str = END):
        self.vocab, self.end = vocab, end
        n = max(vocab.values()) + 1
        self.labels = [""] * n
        for s, i in vocab.items():
            self.labels[i] = s
        self.born = born = [-1] * n  # the merge that made a label
        self.left, self.right, self.live = [-1] * n, [-1] * n, [True] * n
        self.cut: dict[int, int] = {}  # (u, v) -> the merge whose gadget took v from u's state
        self.n = n
        self._arcs: dict[int, bool] = {}
        for k, (u, v) in enumerate(merges):
            a, b, ab = vocab[u], vocab[v], vocab[u + v]
            if born[ab] >= 0:
                raise ValueError(f"two merges make {u + v!r}")
            if self.has(a, k, b):
                self.cut[a * n + b] = k
            else:
                self.live[ab] = False
            born[ab], self.left[ab], self.right[ab] = k, a, b
        self.first = [False] * n  # labels on an arc from the start
        for x in sorted(vocab.values(), key=lambda x: born[x]):
            self.first[x] = born[x] < 0 or self.live[x] and self.first[self.left[x]]
        self.longest = max(len(s.removesuffix(end)) for s in vocab)

    def has(self, label: int, merges: int, x: int) -> bool:
        """Whether the state that label leads to after so many merges has an arc x."""
        born, n = self.born, self.n
        while True:
            if self.cut.get(label * n + x, merges) < merges:
                return False
            if born[x] < born[label]:  # from when the label's state was that of its right part
                merges, label = born[label], self.right[label]
            elif born[x] < 0:
                return True
            elif not self.live[x]:
                return False
            else:  # it came with a gadget, to the states that had an arc for its left part once the copy was made
                merges, x = born[x] + 1, self.left[x]

    def arc(self, label: int, x: int) -> bool:
        key = label * self.n + x
        if (known := self._arcs.get(key)) is None:
            if len(self._arcs) > 2_000_000:
                self._arcs.clear()
            known = self._arcs[key] = self.has(label, 1 << 60, x)
        return known

    def encode(self, word: str) -> list[int]:
        """The labels along the one path that spells the word (in symbols, without the end mark).

        From each place the longest label is tried first, then shorter ones. A prefix has one path only, so a place
        that led nowhere leads nowhere again."""
        n, find, end, longest, arcs, size = len(word), self.vocab.get, self.end, self.longest, self._arcs, self.n
        out: list[int] = []
        starts: list[int] = []
        dead: set[int] = set()
        at, top = 0, min(n, longest)
        while at < n:
            last = out[-1] if out else -1
            for stop in range(at + top, at, -1):
                if stop in dead:
                    continue
                x = find(word[at:stop] + end if stop == n else word[at:stop])
                if x is None:
                    continue
                if last < 0:
                    if not self.first[x]:
                        continue
                else:
                    known = arcs.get(last * size + x)
                    if not (self.arc(last, x) if known is None else known):
                        continue
                out.append(x)
                starts.append(at)
                at = stop
                top = min(n - at, longest)
                break
            else:
                if not out:
                    raise ValueError(f"no path spells {word!r}")
                dead.add(at)
                out.pop()
                at, back = starts.pop(), at
                top = back - at - 1
        return out


class _Memory(dict):
    """What of() gave for each key; emptied when keys and values come to ``most`` bytes. Long keys are not kept."""

    def __init__(self, of, most: int, longest: int = 1000):
        self.of, self.most, self.longest, self.size = of, most, longest, 0

    def __missing__(self, key: str) -> bytes:
        value = self.of(key)
        if len(key) <= self.longest:
            if self.size > self.most:
                self.clear()
                self.size = 0
            self.size += 4 * len(key) + len(value) + 200  # with what Python adds
            self[key] = value
        return value


class Tokenizer:
    """A vocabulary file's normalizer, split and merges. Words met are remembered, up to ``memory`` bytes of them."""

    def __init__(self, path: str, memory: int = 100_000_000):
        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        model = j["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.added = {t["content"]: t["id"] for t in j["added_tokens"]}
        self.labels = {i: s for i, s in enumerate(self.automaton.labels)} | {i: s for s, i in self.added.items()}
        self.split = regex.compile(j["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.bytes = byte_labels()
        self.memory = memory
        self.chunks, self.pieces = _Memory(self._encode_chunk, memory), _Memory(self._encode_piece, memory)

    def _encode_chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split.findall(chunk)))

    def _encode_piece(self, piece: str) -> bytes:
        symbols = piece if piece.isascii() and piece.isprintable() else "".join([self.bytes[b] for b in piece.encode()])
        ids = self.automaton.encode(symbols)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # each character on its own: no final sigma
        text = text.lower()
        chunks = _SPLIT.split(text) if _ODD.search(text) else text.split()
        return b"".join(map(self.chunks.__getitem__, chunks))

    def encode(self, text: str, special: bool = True) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; without special, the added tokens' strings are plain text."""
        if special and self.special and any(s in text for s in self.added):
            return b"".join(self.added[p].to_bytes(4, "little") if p in self.added else self._plain(p) for p in self.special.split(text))
        return self._plain(text)

    def decode(self, ids) -> str:
        return " ".join(map(self.labels.__getitem__, ids))


_kept: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """One for each file and Python worker."""
    if path not in _kept:
        _kept[path] = Tokenizer(path)
    return _kept[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _place(df: DataFrame, name: str) -> int:
    """Where the column is that Spark finds under a name, whatever its case; its error if there is none or more than one."""
    df.select(name)
    return min((i for i, c in enumerate(df.columns) if c.lower() == name.lower()), key=lambda i: df.columns[i] != name)


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text", digests: bool = False) -> DataFrame:
    """docs with n_tokens, token_ids (array of int) and decoded; with digests, ids_sha256 and decoded_sha256 in place of
    the last two. path: None for the public file's place on each worker."""
    new = [T.StructField("n_tokens", T.LongType())]
    new += [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())] if digests else [T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    names = [f.name for f in new]
    kept = docs.drop(*[c for c in docs.columns if c.lower() in names])
    schema = T.StructType([*kept.schema.fields, *new])
    at_text = _place(kept, text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        tok = tokenizer(path or default_path())
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                n, a, b = [], [], []
                for text in part.column(at_text).to_pylist():
                    raw = tok.encode(text or "")
                    ids = np.frombuffer(raw, "<u4").tolist()
                    decoded = tok.decode(ids)
                    n.append(len(ids))
                    a.append(hashlib.sha256(raw).hexdigest() if digests else ids)
                    b.append(hashlib.sha256(decoded.encode()).hexdigest() if digests else decoded)
                arrays = [pa.array(n, pa.int64()), pa.array(a, pa.string() if digests else pa.list_(pa.int32())), pa.array(b, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], [*part.schema.names, *names])

    return kept.mapInArrow(rows, schema)


def decode(df: DataFrame, path: str | None = None, ids_col: str = "token_ids", out: str = "decoded") -> DataFrame:
    """df with the decoded text of its ids; null ids give null."""
    kept = df.drop(out)
    at_ids = _place(kept, ids_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path or default_path())
        for batch in batches:
            texts = [None if ids is None else tok.decode(ids) for ids in batch.column(at_ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return kept.mapInArrow(rows, T.StructType([*kept.schema.fields, T.StructField(out, T.StringType())]))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, digests=True).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
