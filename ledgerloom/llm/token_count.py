"""Token counts by a linear longest-match automaton.

The vocabulary is a trie with failure links.  Each node knows how many tokens are popped when its link is taken, so a word's
number of greedy longest-match pieces follows in one pass over its characters, without building the pieces.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import text_slices

_UNKNOWN = 1 << 40
#: Words whose counts a task keeps; when it is full it starts anew.
CACHE_WORDS = 400_000
ROOT, INNER = 0, 1


class Automaton:
    """Tries of word-initial and word-inner pieces, their failure links and popped-token counts."""

    def __init__(self, initial: Iterable[str], inner: Iterable[str]):
        self.child: dict[int, int] = {}
        self.link, self.pops = [-1, -1], [0, 0]
        ends = [False, False]
        queue: deque[tuple[int, int, int]] = deque()
        for root, pieces in ((ROOT, initial), (INNER, inner)):
            for piece in pieces:
                node = root
                for c in piece:
                    key = node << 21 | ord(c)
                    new = self.child.get(key, -1)
                    if new < 0:
                        new = self.child[key] = len(ends)
                        ends.append(False)
                    node = new
                if node != root:
                    ends[node] = True
        self.link += [-1] * (len(ends) - 2)
        self.pops += [0] * (len(ends) - 2)
        children: dict[int, list[tuple[int, int]]] = {}
        for key, node in self.child.items():
            children.setdefault(key >> 21, []).append((key & 0x1FFFFF, node))
        queue.extend((root, c, node) for root in (ROOT, INNER) for c, node in children.get(root, ()))
        while queue:
            parent, c, node = queue.popleft()
            if ends[node]:
                self.link[node], self.pops[node] = INNER, 1
            else:
                z, popped = self.link[parent], self.pops[parent]
                while z >= 0 and (z << 21 | c) not in self.child:
                    popped += self.pops[z]
                    z = self.link[z]
                if z >= 0:
                    self.link[node], self.pops[node] = self.child[z << 21 | c], popped
            queue.extend((node, d, n) for d, n in children.get(node, ()))

    def count(self, word: str) -> int:
        """Number of pieces; ``1 + _UNKNOWN`` if some part has no piece."""
        child, link, pops = self.child, self.link, self.pops
        node, n = ROOT, 0
        for c in word:
            key = ord(c)
            while (new := child.get(node << 21 | key)) is None:
                n += pops[node]
                node = link[node]
                if node < 0:
                    return 1 + _UNKNOWN
            node = new
        while node != INNER:
            n += pops[node]
            node = link[node]
            if node < 0:
                return 1 + _UNKNOWN if word else 0
        return n


class _Counts(dict):
    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        n = self[word] = self.automaton.count(word.decode())
        return n


def automaton_of(path: str) -> Automaton:
    """From a SentencePiece file: pieces that open with U+2581 begin words, the other ones go on within them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    return Automaton([p[1:] for p in plain if p[0] == "▁" and "▁" not in p[1:] and len(p) > 1], [p for p in plain if "▁" not in p])


def count_tokens(docs: DataFrame, automaton: Automaton, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens, n_unknown (words that count as one unknown token).

    A word is a run of other characters than ASCII white space; its first piece is the longest word-initial one, each next
    the longest inner one.  Null, empty and wordless texts have 0 of each; repeated rows are counted each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(shared.value)
        for batch in batches:
            words, tokens, unknown = [], [], []
            for _, _, data, offsets in text_slices(batch.column("text")):
                content = data.tobytes()
                for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                    parts = content[a:b].split()
                    total = sum(map(counts.__getitem__, parts))
                    words.append(len(parts))
                    tokens.append(total & (_UNKNOWN - 1))
                    unknown.append(total >> 40)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long"))
