"""Byte pair encoding by backtracking, and decoding through an offset table.

A word is encoded in time linear in its length: an Aho-Corasick automaton gives the longest token that starts at each
position, and a token may follow another only if the merge rules, applied to the two side by side, would leave their border
alone. Where no continuation exists the last token is exchanged for its next shorter prefix. The result equals applying the
merges in rank order.
"""

import json
import re
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm import query

WORD_END = "Ā"  # stands for the suffix of a word's last symbol; all other symbols are bytes 0-255
CACHED_CHUNKS = 400_000
CACHED_WORDS = 400_000
CACHED_PAIRS = 1_000_000
ROWS_PER_BATCH = 500
_ODD_SPACES = re.compile("[\x1c-\x1f]")  # str.split takes these for white space


def _byte_symbols() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use: symbol -> byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizer:
    """A word-end BPE vocabulary with its automaton, pair table and offset table."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, self.suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.by_content = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words_of = regex.compile(pattern).findall
        self.byte_of = _byte_symbols()
        ids = {self._plain(t): i for t, i in vocab.items()}
        self.ids = ids
        self.parts, self.joined = {}, {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right = vocab[a], vocab[b]
            whole = ids[self._plain(a) + self._plain(b)]
            self.joined.setdefault((left, right), (rank, whole))
            self.parts.setdefault(whole, (left, right, rank))
        # Only tokens that the rules can make may be matched: single symbols, and results of merges whose border holds until then.
        self.rank = {i: self.parts[i][2] if i in self.parts else -1 for i in ids.values()}
        texts = {i: t for t, i in ids.items() if self._made(i) or len(t.rstrip(WORD_END)) == 1}
        self.length = {i: len(t) for i, t in texts.items()}
        known = {t: i for i, t in texts.items()}
        self.shorter = {}
        for t, i in known.items():
            self.shorter[i] = next((known[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in known), None)
        self.ends = ahocorasick.Automaton()  # over reversed text: a match's end is the token's start
        for t, i in known.items():
            self.ends.add_word(t[::-1], i)
        self.ends.make_automaton()
        everything = sorted({**{i: t for t, i in vocab.items()}, **{i: t for t, i in self.special.items()}}.items())
        size = everything[-1][0] + 1
        spans = np.zeros(size + 1, np.int64)
        for i, t in everything:
            spans[i + 1] = len(t.encode()) + 1
        self.offsets = np.cumsum(spans)
        self.blob = np.frombuffer("".join(" " + t for _, t in everything).encode(), np.uint8)
        self.pairs, self.chunks, self.words = {}, {}, {}

    def _made(self, token: int) -> bool:
        made = self.parts.get(token)
        return made is not None and self._border_holds(*made)

    def _plain(self, token: str) -> str:
        body, end = (token[: -len(self.suffix)], WORD_END) if token.endswith(self.suffix) else (token, "")
        return "".join(chr(self.byte_of[c]) for c in body) + end

    def compatible(self, left: int, right: int) -> bool:
        """Do the merges leave the border between two finished tokens alone?"""
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._border_holds(left, right)
        return known

    def _border_holds(self, a: int, b: int, own: int | None = None) -> bool:
        """Undo both sides from the latest merge backwards: a border pair that merges before the merge just undone breaks it.

        On equal ranks the left merge goes first. `own`: the rank of the merge that joins the two, which does not count.
        """
        limit_a = limit_b = 1 << 30
        while True:
            made = self.joined.get((a, b))
            if made is not None and made[0] != own and made[0] < min(limit_a, limit_b):
                return False
            ra, rb = self.rank[a], self.rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra >= rb:
                limit_a, limit_b, a = ra, min(limit_b, ra + 1), self.parts[a][1]
            else:
                limit_b, limit_a, b = rb + 1, min(limit_a, rb + 1), self.parts[b][0]

    def encode_word(self, word: str) -> list[int]:
        text = word.encode().decode("latin-1") + WORD_END
        n = len(text)
        longest = [None] * n
        for end, token in self.ends.iter(text[::-1]):
            start = n - 1 - end
            if longest[start] is None or self.length[token] > self.length[longest[start]]:
                longest[start] = token
        alive = bytearray(b"\1") * (n + 1)
        out, at, token = [], 0, longest[0]
        length, shorter, compatible = self.length, self.shorter, self.compatible
        while True:
            last = out[-1] if out else None
            while token is not None:
                end = at + length[token]
                if alive[end] and (last is None or compatible(last, token)):
                    break
                token = shorter[token]
            if token is not None:
                out.append(token)
                at = end
                if at == n:
                    return out
                token = longest[at]
                if token is not None:
                    continue
                token = None
            # nothing can follow: this position is dead, try a shorter last token
            alive[at] = 0
            token = out.pop()
            at -= length[token]

    def _word(self, word: str) -> bytes:
        packed = self.words.get(word)
        if packed is None:
            packed = np.array(self.encode_word(word), "<u4").tobytes()
            if len(word) < 64:
                if len(self.words) >= CACHED_WORDS:
                    self.words.clear()
                self.words[word] = packed
        return packed

    def _chunk(self, chunk: str) -> bytes:
        packed = b"".join(map(self._word, self.words_of(chunk)))
        if len(chunk) < 64:
            if len(self.chunks) >= CACHED_CHUNKS:
                self.chunks.clear()
            self.chunks[chunk] = packed
        return packed

    def _encode_ordinary(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower-casing looks at one character at a time
        chunks = text.lower().split() if _ODD_SPACES.search(text) is None else regex.split(r"\s+", text.lower())
        known = self.chunks.get
        found = list(map(known, chunks))
        if None in found:
            one = self._chunk
            found = [one(c) if f is None else f for c, f in zip(chunks, found)]
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.by_content is None or not any(s in text for s in self.special):
            return self._encode_ordinary(text)
        return b"".join(
            np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._encode_ordinary(p)
            for p in self.by_content.split(text)
        )

    def decode(self, packed: bytes) -> str:
        """Token texts joined by one space, cut from the blob by offsets."""
        ids = np.frombuffer(packed, "<u4").astype(np.int64)
        if not len(ids):
            return ""
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        take = np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)
        return self.blob[take].tobytes()[1:].decode()


@lru_cache(maxsize=2)
def _tokenizer(source: str) -> Tokenizer:
    return Tokenizer(source)


def encode_decode(df: DataFrame, tokenizer_json: str, text: str = "text", ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """Add the packed token ids (little-endian uint32) of every text, their number and the decoded text.

    `tokenizer_json` is the vocabulary file's content (a fixed size, shipped with the task). Null text counts as empty: no
    ids, empty decoded text. Rows are independent: repeated rows give repeated results, an empty table gives an empty table.
    Other columns pass through; columns named like the results are replaced.
    """
    count = f"n_{ids}"
    df = df.drop(*[c for c in (ids, count, decoded) if c != text])
    shipped = df.sparkSession.sparkContext.broadcast(tokenizer_json)
    schema = T.StructType([*df.schema.fields, T.StructField(ids, T.BinaryType()), T.StructField(count, T.LongType()), T.StructField(decoded, T.StringType())])

    def run(batches):
        tok = _tokenizer(shipped.value)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_PER_BATCH):
                batch = whole.slice(start, ROWS_PER_BATCH)
                packed = [tok.encode(t or "") for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
                out = [pa.array(packed, pa.binary()), pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array([tok.decode(p) for p in packed], pa.string())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*batch.schema.names, ids, count, decoded])

    return df.mapInArrow(run, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


@query("op4_bpe_round_trip")
def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    done = encode_decode(docs, default_tokenizer())
    return done.select(
        "doc_id",
        F.col("n_token_ids").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
