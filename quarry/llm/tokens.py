"""Token counts with the whole-token shortcut.

Before any text is read, every vocabulary string that is valid text is encoded
alone; those that come back as one pre-token and one token are proven to count 1
wherever they stand as a pre-token.  A text is then split into pre-tokens, proven
ones are counted directly and only the rest is merged by the tokenizer.

The split uses the tokenizer's own pattern, in ``regex``, for texts whose
characters are all below U+0250, where the two engines agree on letters, numbers
and white space (no test compares every such character yet); other texts are split by the
tokenizer's own pre-tokenizer.  Special strings inside a text are one token each
and cut the text, which is the library's default.

Defined results: a null text counts as empty, 0 bytes and 0 tokens; repeated rows
and rows without a ``doc_id`` are counted like any other.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ship_package

LIMIT = 512
#: Fixed value: the split pattern of the byte-level vocabulary, with its white
#: space spelled out for characters below U+0250.
SPACE = r"\t-\r \x85\xa0"
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+"
           r"|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")
PLAIN_BELOW = "ɐ"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary:
    printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Costs(dict):
    """Tokens of a pre-token: 1 for proven strings, which stay; merged costs of
    others are kept while there are not too many."""

    LIMIT = 300_000

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.proven = self._prove()
        self.update(dict.fromkeys(self.proven, 1))

    def _prove(self) -> list[str]:
        alphabet = byte_alphabet()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        texts = []
        for s in self.tokenizer.get_vocab(with_added_tokens=False):
            if s not in special and all(c in alphabet for c in s):
                try:
                    texts.append(bytes(alphabet[c] for c in s).decode())
                except UnicodeDecodeError:
                    continue
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        alone = [t for t in texts if t and len(split(t)) == 1]
        return [t for t, e in zip(alone, self.tokenizer.encode_batch(alone, add_special_tokens=False))
                if len(e.ids) == 1]

    def merged(self, pretoken: str) -> int:
        return len(self.tokenizer.encode(pretoken, add_special_tokens=False).ids)

    def __missing__(self, pretoken: str) -> int:
        n = self.merged(pretoken)
        if len(pretoken) <= 40:
            if len(self) >= self.LIMIT + len(self.proven):
                self.clear()
                self.update(dict.fromkeys(self.proven, 1))
            self[pretoken] = n
        return n


class Counter:
    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.alphabet = byte_alphabet()
        self.costs = Costs(self.tokenizer)
        self.split = regex.compile(PATTERN).findall
        special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.starts = {s[:2] for s in special}

    def plain(self, text: str) -> int:
        if not text:
            return 0
        if text.isascii() or max(text) < PLAIN_BELOW:
            return sum(map(self.costs.__getitem__, self.split(text)))
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return sum(self.costs[bytes(self.alphabet[c] for c in piece).decode()] for piece, _ in pieces)

    def count(self, text: str) -> int:
        if self.special is not None and any(s in text for s in self.starts):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self.plain, parts))
        return self.plain(text)


_LOADED: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter per worker process and vocabulary."""
    if path not in _LOADED:
        _LOADED[path] = Counter(path)
    return _LOADED[path]


def _counts(path: str):
    def run(batches):
        c = counter(path)
        for b in batches:
            n = [c.count(t.as_py() or "") for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document."""
    ship_package(docs.sparkSession)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("n_bytes"), "text").mapInArrow(
        _counts(tokenizer), "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
