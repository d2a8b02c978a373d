"""Byte-level BPE by prefix dynamic programming: encoding, decoding, appends and edits."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostar.llm.common import pick, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Entries that a task keeps of each of its tables before it empties them.
KEPT_PIECES, KEPT_PAIRS = 500_000, 400_000
#: Longer pieces are encoded each time they come up.
LONGEST_KEPT = 64
#: Unicode white space. A place after another character and before one of these ends a piece of the pattern.
_WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
IDS = np.dtype("<u4")


class Vocabulary:
    """Tokens by rank. Every single byte must be a token and rank below all merged ones,
    and a merged token must come from two of lower rank."""

    def __init__(self, ranks: dict[bytes, int], parts: dict[int, tuple[int, int] | None] | None = None):
        self.rank = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks))
        merged = min((r for t, r in ranks.items() if len(t) > 1), default=len(ranks))
        if not all(ranks.get(bytes([b]), merged) < merged for b in range(256)):
            raise ValueError("each single byte must be a token and rank below the merged tokens")
        self.parts = parts or {r: self._parts(t, r) for r, t in self.token.items() if len(t) > 1}

    def _parts(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None where merging never gets there."""
        at = [token[i:i + 1] for i in range(len(token))]
        while len(at) > 2:
            best = min(range(len(at) - 1), key=lambda i: self.rank.get(at[i] + at[i + 1], rank))
            if self.rank.get(at[best] + at[best + 1], rank) >= rank:
                return None
            at[best:best + 2] = [at[best] + at[best + 1]]
        return self.rank[at[0]], self.rank[at[1]]


def read_vocabulary(path: str) -> Vocabulary:
    """A rank file: a line per token, its bytes in base64 and its rank."""
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


class Encoder:
    """Encodes pieces and texts. Keeps no text beyond its bounded tables."""

    def __init__(self, vocabulary: Vocabulary, pattern: str = public_tokenizers.PATTERN):
        self.v = vocabulary
        self.split = regex.compile(pattern).findall
        #: Where a text may be cut without changing how the pattern splits it.
        self.edges = regex.compile(f"(?<=[^{_WHITE}])(?=[{_WHITE}])") if pattern == public_tokenizers.PATTERN else None
        tokens = ahocorasick.Automaton()
        for t, r in vocabulary.rank.items():
            if len(t) == 1 or vocabulary.parts[r]:
                tokens.add_word(t.decode("latin-1"), (r, len(t)))
        tokens.make_automaton()
        self.ending = tokens.iter
        self._apart: dict[int, bool] = {}
        self._pieces: dict[str, bytes] = {}

    def apart(self, left: int, right: int) -> bool:
        """Whether merging leaves these two tokens side by side.

        Their formation is undone from its end, the younger token first. Where
        a merge across the border outranks the step just undone, it would
        have come first.
        """
        v, before = self.v, float("inf")
        while True:
            across = v.rank.get(v.token[left] + v.token[right])
            if across is not None and across < before:
                return False
            younger = max(left, right)
            made = v.parts.get(younger)
            if made is None:
                return True
            if younger == right:  # of equal merges the left one comes first, so the one across would
                before, right = younger + 1, made[0]
            else:
                before, left = younger, made[1]

    def fill(self, data: bytes, last: list[int], known: list[int] | None = None, shift: int = 0,
             free: int = 0) -> None:
        """Append to ``last`` (one entry for each prefix that has one) those of the longer prefixes of ``data``.

        last[i] is the one token that can end the encoding of data[:i]; last[0] is -1.
        ``known`` are entries of a text that equals this one, moved by ``shift``, beyond place
        ``free``: once as many entries as a token is long agree, the rest are taken from there.
        """
        seen, longest, begun, same = self._apart, self.v.longest, len(last), 0
        skip = max(0, begun - longest)
        # Every token that ends at each place, found in one pass; a single byte always does.
        for end, (t, n) in self.ending(data[skip:].decode("latin-1")):
            i = skip + end + 1
            if i < len(last):
                continue
            p = last[i - n]
            if p >= 0:
                key = p << 32 | t
                ok = seen.get(key)
                if ok is None:
                    if len(seen) >= KEPT_PAIRS:
                        seen.clear()
                    ok = seen[key] = self.apart(p, t)
                if not ok:
                    continue
            last.append(t)
            if known is not None and i - longest > max(free, shift):
                same = same + 1 if known[i - shift] == t else 0
                if same > longest:
                    last.extend(known[i - shift + 1:])
                    return

    def tokens(self, data: bytes, last: list[int]) -> list[int]:
        """The encoding that ``last`` holds; a piece that is a token itself is that token."""
        whole = self.v.rank.get(data)
        if whole is not None:
            return [whole]
        out, i, token = [], len(data), self.v.token
        while i:
            out.append(last[i])
            i -= len(token[last[i]])
        out.reverse()
        return out

    def piece(self, text: str) -> bytes:
        got = self._pieces.get(text)
        if got is None:
            data = text.encode("utf-8", "replace")
            whole = self.v.rank.get(data)
            if whole is not None:
                ids = [whole]
            else:
                last = [-1]
                self.fill(data, last)
                ids = self.tokens(data, last)
            got = np.array(ids, dtype=IDS).tobytes()
            if len(text) <= LONGEST_KEPT:
                if len(self._pieces) >= KEPT_PIECES:
                    self._pieces.clear()
                self._pieces[text] = got
        return got

    def text(self, text: str | None) -> bytes:
        """Token ids, four little-endian bytes each."""
        known, new = self._pieces.get, self.piece
        return b"".join([known(p) or new(p) for p in self.split(text)]) if text else b""

    def decoded(self, ids: bytes) -> bytes:
        token = self.v.token
        return b"".join([token[i] for i in np.frombuffer(ids, dtype=IDS).tolist()])

    def edited(self, text: str, ids: bytes, at: int, removed: int, added: str) -> tuple[str, bytes, int]:
        """New text, its ids, and the number of its characters that were encoded anew.

        Only the text between the two nearest borders is encoded; the ids on both sides stay.
        """
        at = max(0, min(at, len(text)))
        end = min(len(text), at + max(0, removed))
        new = text[:at] + added + text[end:]
        lo, hi = 0, len(text)
        if self.edges is not None:
            back = at - 1
            while back > 0 and not self.edges.match(text, back):
                back -= 1
            lo = max(back, 0)
            # The character before a border must stand after the edit, so that both texts have it.
            after = self.edges.search(text, end + 1)
            hi = after.start() if after else len(text)
        widths = np.cumsum([0] + [len(self.v.token[i]) for i in np.frombuffer(ids, dtype=IDS).tolist()])
        head = len(text[:lo].encode("utf-8", "replace"))
        tail = widths[-1] - len(text[hi:].encode("utf-8", "replace"))
        first, rest = np.searchsorted(widths, [head, tail])
        middle = text[lo:at] + added + text[end:hi]
        return new, ids[:4 * first] + self.text(middle) + ids[4 * rest:], len(middle)


class Prefixes:
    """A growing or changing piece with the last token of each of its byte prefixes."""

    def __init__(self, encoder: Encoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Entries of the old prefixes stay: an append costs its own length."""
        self.data += more
        self.encoder.fill(self.data, self.last)

    def edit(self, at: int, removed: int, added: bytes) -> None:
        """Entries before the edit stay; behind it they are filled until they fall in with the old ones."""
        old = self.last
        self.data = self.data[:at] + added + self.data[at + removed:]
        self.last = old[:at + 1]
        self.encoder.fill(self.data, self.last, old, len(added) - removed, at + len(added))

    def ids(self) -> list[int]:
        return self.encoder.tokens(self.data, self.last)


def _ship(df: DataFrame, path: str | None):
    """The ranks as a broadcast: a file of fixed size, read by the driver alone.

    Plain values travel, so executors need no copy of this package.
    """
    v = read_vocabulary(path or public_tokenizers.path(VOCABULARY))
    return df.sparkSession.sparkContext.broadcast({"rank": v.rank, "parts": v.parts})


def _encoder(shared, pattern: str = public_tokenizers.PATTERN) -> Encoder:
    """One encoder a Python worker, kept with the broadcast, so that its tables serve all tasks."""
    kept = shared.value
    if pattern not in kept:
        kept[pattern] = Encoder(Vocabulary(kept["rank"], kept["parts"]), pattern)
    return kept[pattern]


def encode(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, ids (binary, four little-endian bytes a token), n_tokens of each row of ``docs``.

    ``path`` is a rank file. Each match of ``pattern`` is encoded separately:
    for each byte prefix the one token that can end its encoding is found from
    those of shorter prefixes, and the tokens are read from the end. No
    special tokens.

    Cases: null and empty texts have no tokens; every row has its own answer,
    also if it repeats or has a null id; an empty table gives no rows.
    """
    shared = _ship(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared, pattern)
        for batch in batches:
            ids = [enc.text(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())],
                ["doc_id", "ids", "n_tokens"])

    base = pick(docs, "doc_id", "text")
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(run, f"doc_id {kind}, ids binary, n_tokens long")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """The columns of ``encoded`` and ``decoded``, the bytes that its ids stand for.

    Cases: null ids decode to no bytes; an id that is no token fails the job.
    """
    shared = _ship(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared)
        for batch in batches:
            out = [enc.decoded(x.as_py() or b"") for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             [*batch.schema.names, "decoded"])

    base = pick(encoded, *[c for c in ("doc_id", "ids", "n_tokens") if c in encoded.columns])
    return base.mapInArrow(run, base.schema.simpleString()[7:-1].replace(":", " ") + ", decoded binary")


def edit(encoded: DataFrame, edits: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text, ids, n_tokens, anew of each row of ``encoded`` (doc_id, text, ids) after its edit.

    ``edits`` holds doc_id, at, removed, added: at character ``at`` (null: the
    end, an append) ``removed`` characters go and ``added`` comes. Only the
    text up to the white space around the edit is encoded (``anew``
    characters); the other ids are kept.

    Cases: rows without an edit stay as they are (anew 0); several edits of a
    document give a row each, from the same old text; null added is empty;
    places beyond the text mean its end; null text is empty.
    """
    shared = _ship(encoded, path)
    left, right = pick(encoded, "doc_id", "text", "ids"), pick(edits, "doc_id", "at", "removed", "added")
    both = left.join(right.withColumn("hit", F.lit(True)), "doc_id", "left").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("ids", F.lit(b"")).alias("ids"),
        F.coalesce("at", F.lit(2**31 - 1)).cast("long").alias("at"),
        F.coalesce("removed", F.lit(0)).cast("long").alias("removed"), F.coalesce("added", F.lit("")).alias("added"),
        F.coalesce("hit", F.lit(False)).alias("hit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared)
        for batch in batches:
            rows = [enc.edited(r["text"], r["ids"], r["at"], r["removed"], r["added"]) if r["hit"]
                    else (r["text"], r["ids"], 0) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([len(r[1]) // 4 for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
                ["doc_id", "text", "ids", "n_tokens", "anew"])

    kind = left.schema["doc_id"].dataType.simpleString()
    return both.mapInArrow(run, f"doc_id {kind}, text string, ids binary, n_tokens long, anew long")


def op11_bpe(spark, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes they decode to, as digests."""
    done = decode(encode(table(spark, sf_dir, "documents")))
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
