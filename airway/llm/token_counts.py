"""Token counts of documents under a unigram vocabulary.

Distinct pre-tokens (words with a mark for the space before them) are a trie, which sorted
words list depth first. A node holds the best score of any segmentation of its prefix and the
number of its tokens, computed once from the nodes above it, so words with one beginning
share that work; only the branch at hand is in memory. Terminal nodes leave their counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from airway.llm.batches import as_bytes, slices

SPACE = "▁"
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# A task gathers text up to this many bytes, or new words up to this many letters, for one trie, and
# forgets the counts of whole words at so many of them (about 130 MB); they come out the same again.
TEXT_BYTES, TRIE_NODES, COUNTED_WORDS = 16_000_000, 5_000_000, 1_000_000


def load_vocabulary(path: str) -> dict[str, float]:
    """Pieces of a SentencePiece model with log probabilities by Zipf's law from their
    order in the file (a merge vocabulary has ranks, no probabilities). Control, unknown
    and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return zipf_scores(pieces)


def zipf_scores(pieces: list[str]) -> dict[str, float]:
    total = math.log(sum(1 / (k + 1) for k in range(len(pieces))))
    return {p: -math.log(k + 1) - total for k, p in enumerate(pieces)}


class PrefixTrie:
    """Best segmentations of all prefixes of some words.

    A node is ``(score, tokens, open)``; ``open`` lists the pieces that have
    begun and may go on: the score and tokens before them and their place in the trie of
    pieces. So a new node looks at pieces that can still match, not at all lengths. A
    character that no piece holds is as many tokens as its UTF-8 bytes, each scored worse
    than any piece; equal scores go to fewer tokens."""

    def __init__(self, pieces: dict[str, float]):
        self.unknown = min(pieces.values(), default=0.0) - 10.0
        self.starts: dict = {}
        for piece, score in pieces.items():
            place = self.starts
            for char in piece:
                place = place.setdefault(char, {})
            place[""] = score

    def tokens(self, words: list[str]) -> list[int]:
        """Tokens of the best segmentation of each of the words, which are sorted."""
        starts, unknown, found, last = self.starts, self.unknown, [], ""
        branch: list[tuple] = [(0.0, 0, ())]
        for word in words:
            shared = 0
            for a, b in zip(word, last):  # noqa: B905
                if a != b:
                    break
                shared += 1
            del branch[shared + 1 :]
            score, tokens, begun = branch[-1]
            for char in word[shared:]:
                best, count, going = None, 0, []
                place = starts.get(char)
                if place is not None:
                    going.append((score, tokens, place))
                    if "" in place:
                        best, count = score + place[""], tokens + 1
                for before, many, place in begun:
                    place = place.get(char)
                    if place is not None:
                        going.append((before, many, place))
                        if "" in place:
                            other = before + place[""]
                            if best is None or other > best or other == best and many + 1 < count:
                                best, count = other, many + 1
                if best is None:
                    size = len(char.encode("utf-8", "surrogatepass"))
                    best, count = score + unknown * size, tokens + size
                score, tokens, begun = best, count, going
                branch.append((score, tokens, begun))
            found.append(tokens)
            last = word
        return found


def count_tokens(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    pieces: dict[str, float] | None = None,
    trie_nodes: int = TRIE_NODES,
    counted_words: int = COUNTED_WORDS,
    text_bytes: int = TEXT_BYTES,
) -> DataFrame:
    """One row per input row: ``id, n_pretokens, n_tokens``.

    Pre-tokens are words between ASCII white space with the space mark before them. The
    vocabulary (or ``pieces`` with scores) is read by the driver and sent with the tasks,
    about 1 MB. Null and empty texts have no tokens. Rows are independent, so repeated
    rows and rows without id give a row each, and an empty table gives none. A text is read
    whole, however long."""
    known = pieces if pieces is not None else load_vocabulary(vocabulary)
    shape = StructType.fromDDL("id long, n_pretokens long, n_tokens long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, trie = to_arrow_schema(shape), PrefixTrie(known)
        counts: dict[bytes, int] = {}
        held: list[tuple] = []
        new: set[bytes] = set()
        size = letters = 0

        def out() -> pa.RecordBatch:
            if len(counts) > counted_words:
                counts.clear()
                new.update(*(raw.split() for _, raw in held))
            named = sorted((SPACE + word.decode("utf-8", "replace"), word) for word in new)
            counts.update(zip((word for _, word in named), trie.tokens([name for name, _ in named]), strict=True))
            words = [raw.split() for _, raw in held]
            totals = [sum(map(counts.__getitem__, some)) for some in words]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k.type) for c, k in zip(([i for i, _ in held], [len(w) for w in words], totals), kinds, strict=True)], schema=kinds
            )

        for batch in slices(batches):
            for i, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = raw or b""
                held.append((i, raw))
                fresh = set(raw.split()).difference(counts, new)
                new |= fresh
                size, letters = size + len(raw), letters + sum(map(len, fresh))
                if size >= text_bytes or letters >= trie_nodes:
                    yield out()
                    held, new, size, letters = [], set(), 0, 0
        if held:
            yield out()

    return docs.select(F.col(id_column).alias("id"), as_bytes(text)).mapInArrow(run, shape)
