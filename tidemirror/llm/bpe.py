"""BPE encoding and decoding with forced boundaries.

A pair of neighbouring symbols that no vocabulary token holds can never be merged
across, whatever the merge order. Such pairs mark certain cuts: a word falls into
fragments that are encoded one by one and whose ids are put together again. Words
and white-space separated pieces repeat, so each worker keeps the ids of those it saw.

Ids are packed as little-endian unsigned 32-bit integers, the layout of token shards.
"""

from __future__ import annotations

import heapq
import json
import sys
import types
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemirror.llm.texts import slices, with_fields

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Characters with the Unicode property White_Space; Python's own split takes four more.
SPACE = "\t-\r \x85\xa0  -     　"
NOT_SPACE = "\x1c\x1d\x1e\x1f"
SPACES = regex.compile(f"[{SPACE}]+")
NONE, LOW = 1 << 62, (1 << 32) - 1
# Bytes that a worker keeps of pieces and words it has met, and the longest one kept.
KEPT_PIECES, KEPT_WORDS, LONGEST_KEPT = 72 << 20, 40 << 20, 64


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Kept(dict):
    """What ``make`` gave for each key, in at most ``most`` bytes; long keys are not kept.

    Half of the bytes are for what was asked for lately, half for what was before; when the
    first half is full it takes the place of the second, so common keys stay.
    """

    def __init__(self, make, most: int) -> None:
        self.make, self.half, self.held, self.older = make, most // 2, 0, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
            if len(key) > LONGEST_KEPT:
                return found
        # Two objects and a place in the table.
        size = len(key) + len(found) + 190
        if self.held + size > self.half:
            self.older, self.held = dict(self), 0
            self.clear()
        self.held += size
        self[key] = found
        return found


class Codec:
    """Encoder and decoder of one vocabulary file in the tokenizers JSON form."""

    def __init__(self, raw: bytes) -> None:
        spec = json.loads(raw)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError("only plain BPE vocabularies are supported")
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.letters = byte_letters()
        # Ids of the symbol of each byte, inside a word and at its end.
        self.inner = [vocab[c] for c in self.letters]
        self.final = [vocab[c + self.suffix] for c in self.letters]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left] << 32 | vocab[right]] = rank << 32 | vocab[left + right]
        self.inside = self._pairs_inside(vocab)
        self.names = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: t for t, i in self.special.items()}
        self.split_special = regex.compile("|".join(f"({regex.escape(t)})" for t in self.special)) if self.special else None
        self._read_steps(spec)
        # Unicode tables differ between versions: beyond the oldest blocks the file's own steps are asked.
        self.steps = Tokenizer.from_buffer(raw)
        self.kept_words = Kept(self._word, KEPT_WORDS)
        self.pieces = Kept(self._piece, KEPT_PIECES)
        self.byte_decoder = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        if spec.get("decoder") and not self.byte_decoder:
            raise ValueError("only byte-level decoders are supported")
        self.bytes_of = {c: b for b, c in enumerate(self.letters)}

    def _read_steps(self, spec: dict) -> None:
        norm = spec.get("normalizer") or {}
        self.lower = False
        for step in norm.get("normalizers", [norm] if norm else []):
            if step["type"] == "Lowercase":
                self.lower = True
            elif step["type"] != "NFC" and (step["type"], step.get("pattern"), step.get("content")) != ("Replace", {"Regex": "\\s+"}, " "):
                raise ValueError(f"normalizer {step} is not supported")
        pre = spec["pre_tokenizer"]
        pattern = None
        for step in pre.get("pretokenizers", [pre]):
            if step["type"] == "Split" and step["behavior"] == "Removed" and step["invert"]:
                pattern = step["pattern"]["Regex"]
            elif step["type"] != "ByteLevel" or step.get("add_prefix_space") or step.get("use_regex", True):
                raise ValueError(f"pre-tokenizer {step} is not supported")
        if pattern is None or "[^\\s" not in pattern:
            raise ValueError("a pre-tokenizer whose words hold no white space is needed")
        # White space is the Unicode property here, not Python's wider set.
        self.words = regex.compile(pattern.replace("[^\\s", f"[^{SPACE}"))

    def _pairs_inside(self, vocab: dict[str, int]) -> set[int]:
        """All pairs of neighbouring symbols that some token holds."""
        inside = set()
        for token in vocab:
            last = self.suffix and token.endswith(self.suffix)
            symbols = list(token[: -len(self.suffix)] if last else token)
            if last and symbols:
                symbols[-1] += self.suffix
            ids = [vocab.get(s, 0) for s in symbols]
            inside.update(a << 32 | b for a, b in zip(ids, ids[1:]))
        return inside

    def cuts(self, symbols: list[int]) -> list[int]:
        """Where a word of these symbols falls apart for certain."""
        inside = self.inside
        return [i for i, (a, b) in enumerate(zip(symbols, symbols[1:]), 1) if a << 32 | b not in inside]

    def _word(self, word: bytes) -> bytes:
        """Packed ids of a word, fragment by fragment."""
        inner = self.inner
        symbols = [inner[b] for b in word]
        symbols[-1] = self.final[word[-1]]
        cuts = self.cuts(symbols)
        if not cuts:
            return self._merge(symbols)
        return b"".join([self._merge(symbols[a:b]) for a, b in zip([0, *cuts], [*cuts, len(symbols)])])

    def _merge(self, parts: list[int]) -> bytes:
        """Packed ids of one fragment: the first pair of the lowest rank is merged, again and again."""
        if len(parts) > 64:
            return array("I", self._merge_long(parts)).tobytes()
        merges = self.merges
        found = [merges.get(a << 32 | b, NONE) for a, b in zip(parts, parts[1:])]
        while found:
            best = min(found)
            if best == NONE:
                break
            i = found.index(best)
            parts[i : i + 2] = [best & LOW]
            del found[i]
            if i < len(found):
                found[i] = merges.get(parts[i] << 32 | parts[i + 1], NONE)
            if i:
                found[i - 1] = merges.get(parts[i - 1] << 32 | parts[i], NONE)
        return array("I", parts).tobytes()

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same with a heap over linked parts, for fragments of many symbols."""
        after = [*range(1, len(parts)), -1]
        before = [-1, *range(len(parts) - 1)]
        alive = list(parts)

        def entry(i: int, j: int):
            pair = alive[i] << 32 | alive[j]
            best = self.merges.get(pair)
            return None if best is None else (best >> 32, i, pair, best & LOW)

        heap = [e for i in range(len(parts) - 1) if (e := entry(i, i + 1))]
        heapq.heapify(heap)
        while heap:
            _, i, pair, joined = heapq.heappop(heap)
            j = after[i]
            if alive[i] < 0 or j < 0 or alive[i] << 32 | alive[j] != pair:
                continue
            alive[i], alive[j] = joined, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (e := entry(a, b)):
                    heapq.heappush(heap, e)
        return [p for p in alive if p >= 0]

    def _words_of(self, piece: str) -> list[bytes]:
        if piece.isascii() or max(piece) < "\u0250":
            return [w.encode() for w in self.words.findall(piece.lower() if self.lower else piece)]
        steps = self.steps
        own = steps.normalizer.normalize_str(piece) if steps.normalizer else piece
        return [bytes(map(self.bytes_of.__getitem__, w)) for w, _ in steps.pre_tokenizer.pre_tokenize_str(own)]

    def _piece(self, piece: str) -> bytes:
        return b"".join([self.kept_words[w] for w in self._words_of(piece)])

    def _plain(self, text: str) -> bytes:
        if any(c in text for c in NOT_SPACE):
            return b"".join([self.pieces[p] for p in SPACES.split(text) if p])
        return b"".join(map(self.pieces.__getitem__, text.split()))

    def encode(self, text: str | None) -> bytes:
        """Packed ids of a whole text; the text of an added token becomes its id."""
        if not text:
            return b""
        if self.split_special is None or not any(t in text for t in self.special):
            return self._plain(text)
        out = []
        for part in self.split_special.split(text):
            if part:
                out.append(np.array([self.special[part]], "<u4").tobytes() if part in self.special else self._plain(part))
        return b"".join(out)

    def decode(self, packed: bytes | None) -> str:
        """The text of packed ids; unknown ids are left out."""
        tokens = [t for t in map(self.names.get, np.frombuffer(packed or b"", "<u4").tolist()) if t is not None]
        if not self.byte_decoder:
            return " ".join(tokens)
        own = self.bytes_of
        raw = b"".join(t.encode() if t in self.special or any(c not in own for c in t) else bytes(own[c] for c in t) for t in tokens)
        return raw.decode(errors="replace")


def codec(spec) -> Codec:
    """The worker's codec of a broadcast vocabulary; later tasks of the worker find what it keeps."""
    kept = sys.modules.setdefault("_tidemirror_codecs", types.ModuleType("_tidemirror_codecs"))
    if getattr(kept, "key", None) != (len(spec.value), hash(spec.value)):
        kept.codec, kept.key = Codec(spec.value), (len(spec.value), hash(spec.value))
    return kept.codec


def load(df: DataFrame, path: str):
    """The vocabulary file, read once by the driver and sent to every worker; a few MB."""
    return df.sparkSession.sparkContext.broadcast(Path(path).read_bytes())


def encode_documents(docs: DataFrame, path: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """Add the packed ids of ``text``. Every other column is passed on; a column named ``out`` is replaced.

    A null or empty text has no ids (an empty binary). Repeated rows stay, an empty table
    gives an empty table. Whole texts of any length are encoded.
    """
    spec = load(docs, path)
    docs = docs.drop(out)

    def run(batches):
        own = codec(spec)
        for batch in slices(batches, text):
            ids = pa.array([own.encode(t) for t in batch.column(text).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, out])

    return docs.mapInArrow(run, with_fields(docs.schema, **{out: "binary"}))


def decode_documents(docs: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Add the text of packed ids. Null ids give an empty text, ids outside the vocabulary nothing."""
    spec = load(docs, path)
    docs = docs.drop(out)

    def run(batches):
        own = codec(spec)
        for batch in slices(batches, ids):
            texts = pa.array([own.decode(b) for b in batch.column(ids).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, out])

    return docs.mapInArrow(run, with_fields(docs.schema, **{out: "string"}))


def n_tokens(ids: str = "token_ids") -> Column:
    return (F.octet_length(ids) / 4).cast("bigint")


def unpack(ids: str = "token_ids") -> Column:
    """Packed ids as an array of numbers, without Python; null gives an empty array."""
    digits = ", ".join(f"substring(h, 8 * i + {at}, 2)" for at in (7, 5, 3, 1))
    each = f"transform(sequence(0, cast(octet_length({ids}) / 4 as int) - 1), i -> cast(conv(concat({digits}), 16, 10) as bigint))"
    whole = f"get(transform(array(hex({ids})), h -> {each}), 0)"
    return F.expr(f"if(octet_length({ids}) > 0, {whole}, cast(array() as array<bigint>))")
