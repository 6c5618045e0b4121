"""Exact merge-type SentencePiece encoding by backtracking, and decoding.

A token sequence is the result of greedy merging if and only if each adjacent pair of tokens is: the
merges of a pair's joined text give that pair again. So the encoder needs no merge queue over the text:

* an Aho-Corasick automaton over the pieces gives the longest piece that starts at each position;
* the encoder takes the longest piece there, or a shorter prefix of it, that is compatible with the
  token before, where compatibility is checked by re-merging the two pieces' characters (remembered);
* where no piece fits, a bit marks the position as failed, the last token is taken back and a
  shorter one tried; no position is failed twice, so the work is linear in the text.

Text is cut where the vocabulary lets no piece reach over: between two characters that stand next to each other
in no piece, such as a space mark after another character or a comma after a letter in most vocabularies, and
around characters that aren't in the vocabulary, which become byte tokens. Cut units repeat, so each
worker process remembers short ones; what isn't cut is encoded whole.

A model is checked against the library on a few texts when it is loaded; one of another kind raises an error.

Defined results: null and empty texts have no ids and decode to the empty string; decoding follows the
library: one space in front is dropped, broken byte runs become U+FFFD per byte, control tokens nothing,
the unknown id its surface. Rows are independent, so hot sources, copies and ties need no care.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_type, batch_with, documents, extended, pieces

MARK = "▁"
UNKNOWN = " ⁇ "
WORD_CACHE = 600_000
UNIT_CACHE = 400_000
PAIR_CACHE = 300_000
#: Texts on which a model that merges otherwise, normalises or marks its beginning otherwise differs from this encoder.
PROBES = ("", " ", " two  spaces ", "The unbelievable internationalisation, of 12345 things.", "naïve café ﬁ ① Å", "日本語 🙂", "tab\there\nline", "x▁y")
#: Words of a marked text: a run of marks and what follows up to the next.
MARKED = re.compile(f"{MARK}+[^{MARK}]*")


class Vocabulary:
    """Pieces, scores and kinds from a model file, through the library's own accessors."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.surface = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
        self.ids = {p: i for i, p in enumerate(self.surface) if not special[i]}
        self.scores = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.surface) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        if len(self.bytes) not in (0, 256):
            raise ValueError("the model has byte pieces for some bytes only")
        # Only pieces that merging can produce take part.
        self.live = {p for p in self.ids if len(p) == 1 or self.merge(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for p in self.live:
            self.automaton.add_word(p, (p, len(p) - 1))
        self.automaton.make_automaton()
        self.prefix = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.live), None) for p in self.live}
        self.chars = {p for p in self.live if len(p) == 1}
        self.inside = {p[i : i + 2] for p in self.live for i in range(len(p) - 1)}
        self.cuts_at_mark = not any(x[1] == MARK != x[0] for x in self.inside)
        self.raw = [b"" if sp.is_control(i) else p.replace(MARK, " ").encode() for i, p in enumerate(self.surface)]
        self.raw[self.unknown] = UNKNOWN.encode()
        for byte, i in self.bytes.items():
            self.raw[i] = bytes([byte])
        self.marked = {i for i, p in enumerate(self.surface) if p.startswith(MARK)}
        self.controls = {i for i in range(n) if sp.is_control(i)}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merge(self, text: str) -> list[str]:
        """Greedy merging itself: the best-scored adjacent pair first, leftmost on ties."""
        parts = list(text)
        while len(parts) > 1:
            best = min(
                ((-self.scores[m], i) for i in range(len(parts) - 1) if (m := parts[i] + parts[i + 1]) in self.scores),
                default=None,
            )
            if best is None:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def fit(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` gives these two pieces again."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIR_CACHE:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return known

    def backtrack(self, text: str) -> list[str]:
        """Pieces of a text whose characters are all in the vocabulary."""
        longest: list[str] = [""] * len(text)
        for end, (piece, back) in self.automaton.iter(text):
            longest[end - back] = piece  # ends ascend, so the last piece of a start is its longest
        open_ = bytearray(b"\xff") * (len(text) // 8 + 1)  # a bit for each position that may be reached
        out: list[str] = []
        pos, piece, pairs = 0, longest[0], self.pairs
        while True:
            end = pos + len(piece)
            if open_[end >> 3] >> (end & 7) & 1 and (
                not out or (pairs[out[-1], piece] if (out[-1], piece) in pairs else self.fit(out[-1], piece))
            ):
                out.append(piece)
                pos = end
                if pos == len(text):
                    return out
                piece = longest[pos]
                continue
            shorter = self.prefix[piece]
            while shorter is None:
                open_[pos >> 3] &= ~(1 << (pos & 7))
                last = out.pop()
                pos -= len(last)
                shorter = self.prefix[last]
            piece = shorter


class Codec:
    """Encoder and decoder of one model with a bounded memory of cut units; one a worker process."""

    made: dict[str, Codec] = {}

    def __init__(self, path: str):
        import sentencepiece

        self.vocabulary = Vocabulary(path)
        self.words: dict[str, str] = {}
        self.units: dict[str, str] = {}
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        for text in PROBES:
            ids = sp.encode(text)
            if self.encode_text(text) != ",".join(map(str, ids)) or self.decode(ids) != sp.decode(ids):
                raise ValueError(f"{path} isn't a merge model without normalisation and with a leading mark")

    @classmethod
    def of(cls, path: str) -> Codec:
        if path not in cls.made:
            cls.made[path] = cls(path)
        return cls.made[path]

    def unit(self, unit: str) -> str:
        """Comma-joined ids of a unit that no cut divides."""
        ids = self.units.get(unit)
        if ids is None:
            v = self.vocabulary
            if unit not in v.chars and len(unit) == 1:
                found = [v.bytes[b] for b in unit.encode()] if v.bytes else [v.unknown]
            else:
                found = [v.ids[p] for p in v.backtrack(unit)]
            ids = ",".join(map(str, found))
            if len(unit) <= 30:
                if len(self.units) >= UNIT_CACHE:
                    self.units.clear()
                self.units[unit] = ids
        return ids

    def word(self, word: str) -> str:
        """Comma-joined ids of a word: its units are encoded one by one."""
        inside = self.vocabulary.inside
        cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in inside]
        ids = ",".join([self.unit(word[a:b]) for a, b in zip([0, *cuts], [*cuts, len(word)])])
        if len(word) <= 40:
            if len(self.words) >= WORD_CACHE:
                self.words.clear()
            self.words[word] = ids
        return ids

    def encode_text(self, text: str) -> str:
        """Comma-joined decimal ids of a text."""
        if not text:
            return ""
        if not self.vocabulary.cuts_at_mark:
            return self.word(MARK + text.replace(" ", MARK))
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            words = MARKED.findall(MARK + text.replace(" ", MARK))
        else:
            words = (MARK + text.replace(" ", " " + MARK)).split(" ")
        known, get = self.words, self.word
        return ",".join([known.get(w) or get(w) for w in words])

    def decode(self, ids: list[int]) -> str:
        v = self.vocabulary
        data = b"".join(map(v.raw.__getitem__, ids))
        first = next((i for i in ids if i not in v.controls), None)
        return data[first in v.marked :].decode("utf-8", "one_each")


def _one_each(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("one_each", _one_each)

#: What ``add_pieces`` can add, with its types.
OUTPUTS = {
    "ids": "array<int>",
    "decoded": "string",
    "n_tokens": "bigint",
    "ids_sha256": "string",
    "decoded_sha256": "string",
}


def add_pieces(
    df: DataFrame, model: str, text: str = "text", outputs: tuple[str, ...] = ("ids", "decoded", "n_tokens")
) -> DataFrame:
    """``df`` with the chosen ``outputs`` for its column ``text``; decoding works on the ids alone."""
    schema = extended(df.schema, *[(name, OUTPUTS[name]) for name in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(model)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        make = {
            "ids": lambda joined, ids, back: ids,
            "decoded": lambda joined, ids, back: back,
            "n_tokens": lambda joined, ids, back: len(ids),
            "ids_sha256": lambda joined, ids, back: sha(joined),
            "decoded_sha256": lambda joined, ids, back: sha(back),
        }
        for whole in batches:
            for batch in pieces(whole, text, 2 << 20):
                columns: dict[str, list] = {name: [] for name in outputs}
                for t in batch.column(batch.schema.get_field_index(text)).to_pylist():
                    joined = codec.encode_text(t or "")
                    ids = list(map(int, joined.split(","))) if joined else []
                    back = codec.decode(ids)
                    for name in outputs:
                        columns[name].append(make[name](joined, ids, back))
                yield batch_with(batch, **{n: pa.array(x, arrow_type(OUTPUTS[n])) for n, x in columns.items()})

    return df.mapInArrow(run, schema)


def decode_ids(df: DataFrame, model: str, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """``df`` with the text of its id arrays; a null array decodes to the empty string."""
    schema = extended(df.schema, (output, "string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(model)
        for batch in batches:
            found = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            yield batch_with(batch, **{output: pa.array([codec.decode(x or []) for x in found], pa.string())})

    return df.mapInArrow(run, schema)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    outputs = ("n_tokens", "ids_sha256", "decoded_sha256")
    docs = documents(spark, sf_dir, "doc_id", "text")
    return add_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), outputs=outputs).select(
        "doc_id", *map(F.col, outputs)
    )
