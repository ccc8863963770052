"""Token counts by a linear longest-match automaton over a vocabulary.

A word is cut greedily: the longest token that begins it, then the longest that
begins the rest, and so on. The automaton gives the number of pieces without
making them, in one step per byte: a trie of the vocabulary, where each node has
a failure link (the node of what is left, once the tokens that are certain have
been taken off) and the count of the tokens taken off on that link. Links and
counts are worked out once, for all nodes in order of depth.

The vocabulary is one with word ends: tokens are byte strings, and a token may
end with the end of a word. Words are what `WORD` finds in the lower-cased
text; white space is dropped. A word that no cut covers counts as one token.

Each task keeps the counts of words that it has seen, up to `REMEMBER` of them.
Nothing is grouped or shuffled. Defined results: null and empty texts have no
words; repeated rows are counted each; other columns pass through, but for those
named like a result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: a word is a run of letters, digits and underscores, or any one other sign
WORD = re.compile(r"\w+|[^\w\s]")
#: the symbol behind the last byte of a word
END = 256
REMEMBER = 500_000
PATH = "/opt/tokenizers/word_bpe_49k.json"
RESULT = ("n_words", "n_tokens")

Token = tuple[int, ...]


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in vocabularies of byte-level tokenizers.

    Printable bytes stand for themselves; the others are counted up from 256.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


def read_vocabulary(path: str = PATH, end: str = "</w>") -> list[Token]:
    """The tokens of a tokenizer file, as bytes and word ends."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    letters = byte_letters()
    special = {t["content"] for t in model.get("added_tokens", [])}
    tokens = []
    for token in model["model"]["vocab"]:
        body = token.removesuffix(end)
        if token not in special and all(c in letters for c in body):
            tokens.append((*(letters[c] for c in body), *([END] if body != token else [])))
    return tokens


class Automaton:
    """Longest-match piece counts of words."""

    def __init__(self, vocabulary: Iterable[Token]) -> None:
        self.next: dict[int, int] = {}  # node * 512 + symbol -> node
        parents, symbols, ends = [-1], [0], [False]
        for token in vocabulary:
            node = 0
            for symbol in token:
                edge = node * 512 + symbol
                if edge not in self.next:
                    self.next[edge] = len(parents)
                    parents.append(node)
                    symbols.append(symbol)
                    ends.append(False)
                node = self.next[edge]
            ends[node] = ends[node] or node > 0
        n = len(parents)
        depth = [0] * n
        for node in range(1, n):  # a parent is made before its children
            depth[node] = depth[parents[node]] + 1
        #: of each node what is left (-1: no cut goes on) and how many tokens were taken off
        self.fail, self.taken = [-1] * n, [0] * n
        for node in sorted(range(1, n), key=depth.__getitem__):
            if ends[node]:
                self.fail[node], self.taken[node] = 0, 1
                continue
            at, taken = self.fail[parents[node]], self.taken[parents[node]]
            while at >= 0 and at * 512 + symbols[node] not in self.next:
                taken += self.taken[at]
                at = self.fail[at]
            if at >= 0:
                self.fail[node] = self.next[at * 512 + symbols[node]]
                self.taken[node] = taken

    def count(self, word: str) -> int:
        """The number of pieces of a word."""
        node, pieces = 0, 0
        for symbol in (*word.encode("utf-8", "replace"), END):
            while node * 512 + symbol not in self.next:
                pieces += self.taken[node]
                node = self.fail[node]
                if node < 0:
                    return 1
            node = self.next[node * 512 + symbol]
        while node:
            pieces += self.taken[node]
            node = self.fail[node]
            if node < 0:
                return 1
        return pieces


class Counts(dict):
    """Piece counts by word, worked out when first asked for."""

    def __init__(self, automaton: Automaton) -> None:
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        count = self.automaton.count(word)
        if len(self) < REMEMBER:
            self[word] = count
        return count


def counted(docs: DataFrame, vocabulary: Iterable[Token], text: str = "text") -> DataFrame:
    """The documents with columns n_words and n_tokens.

    The vocabulary is broadcast as an automaton, some 20 bytes for each byte of it.
    """
    kept = [c for c in docs.columns if c.lower() not in RESULT]
    sent = docs.sparkSession.sparkContext.broadcast(Automaton(vocabulary))
    frame = docs.select(*kept, *[F.lit(None).cast("long").alias(c) for c in RESULT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Counts(sent.value)
        for batch in batches:
            words, tokens = [], []
            for value in batch.column(text):
                found = WORD.findall((value.as_py() or "").lower())
                words.append(len(found))
                tokens.append(sum(map(lengths.__getitem__, found)))
            columns = [*batch.columns[:-2], pa.array(words, pa.int64()), pa.array(tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return frame.mapInArrow(run, frame.schema)
