"""Token counts under a unigram vocabulary without making tokens: a count-only Viterbi pass.

An Aho-Corasick automaton reports every vocabulary entry that ends at a character. Per end the
dynamic program keeps the best score and the number of pieces on that path, nothing to trace back.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from worklink.llm.common import Recent, id_and_text, per_text

MARK = "▁"  # stands for a blank and begins every word
UNKNOWN_PENALTY = 10.0  # an unknown character scores this much below the worst entry

COUNT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_unknown", pa.int64()), ("score", pa.float64())])


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a vocabulary file, in id order."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnigramCounter:
    """Best segmentation's score and size, by the tie rules of the tokenizers library.

    Scores add up from the left in double precision. A path replaces another only
    when its score is strictly greater and starts are tried from the left, so of
    equal paths into one end the one with the longest last piece stays. A character
    that no entry of its own covers may be unknown, tried after the longer pieces.
    The unknown entry's own spelling is ordinary text. Runs of unknown characters count as their bytes where the vocabulary has byte
    pieces, else as one piece.
    """

    def __init__(self, vocabulary: list[tuple[str, float]], unknown_id: int = 0):
        self.scores = {piece: float(score) for piece, score in vocabulary}
        self.unknown_piece = vocabulary[unknown_id][0]
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY
        self.has_bytes = all(f"<0x{b:02X}>" in self.scores for b in range(256))
        self._build()

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("scores", "unknown", "unknown_piece", "has_bytes")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._build()

    def _build(self):
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            if piece and piece != self.unknown_piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.words = Recent(self.best)

    def best(self, word: str) -> tuple[int, int, float]:
        """Pieces, unknown characters and score of a word's best path."""
        n = len(word)
        score: list[float | None] = [0.0] + [None] * n
        pieces, strange, in_run = [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        ends = self.automaton.iter(word)
        found = next(ends, None)
        for end in range(1, n + 1):
            single = False
            # matches with one end come longest first
            while found is not None and found[0] == end - 1:
                length, value = found[1]
                start = end - length
                single |= length == 1
                total = value + score[start]
                if score[end] is None or total > score[end]:
                    score[end], pieces[end], strange[end], in_run[end] = total, pieces[start] + 1, strange[start], False
                found = next(ends, None)
            if not single:
                total = self.unknown + score[end - 1]
                if score[end] is None or total > score[end]:
                    cost = len(word[end - 1].encode("utf-8", "surrogatepass")) if self.has_bytes else int(not in_run[end - 1])
                    score[end], pieces[end] = total, pieces[end - 1] + cost
                    strange[end], in_run[end] = strange[end - 1] + 1, True
        return pieces[n], strange[n], score[n]

    def count(self, text: str) -> tuple[int, int, float]:
        """Totals over the words of a text; blanks begin words."""
        if not text:
            return 0, 0, 0.0
        marked = text.replace(" ", MARK)
        words = marked[1:] if marked.startswith(MARK) else marked
        found = [self.words[MARK + w] for w in words.split(MARK)]
        return sum([f[0] for f in found]), sum([f[1] for f in found]), sum([f[2] for f in found])


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_tokens, n_unknown (characters) and score of every whole text's best segmentation.

    `vocabulary` is the path of a piece file, read on the driver and sent to the
    executors. A null or empty text has no tokens, score 0. Repeated rows give
    repeated results, a null id stays null, other columns are not read.
    """
    counter = docs.sparkSession.sparkContext.broadcast(UnigramCounter(read_vocabulary(vocabulary)))

    def run(batches):
        yield from per_text(counter.value.count, COUNT)(batches)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, n_unknown long, score double")
