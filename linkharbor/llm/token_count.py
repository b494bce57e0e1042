"""Token counts of whole texts, as sentencepiece gives them, by the whole-token shortcut.

No vocabulary string holds a blank after another character, so no merge crosses the place where a
blank follows a word: a text's count is the sum over its segments, each a run of blanks and the word
behind it. `whole_tokens` proves once, on the driver, which single-blank words encode alone as one
token; those are counted at sight, and only other segments are merged.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from linkharbor.llm.common import batch_of, id_and_text, small_batches, texts_of

BLANK = "▁"  # how the vocabulary writes a blank
MERGED_ENTRIES = 400_000

_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
_segments = re.compile(" +[^ ]*").findall


@lru_cache(maxsize=4)
def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def whole_tokens(path: str) -> list[str]:
    """Words that, behind one blank, are one token. Fails for a vocabulary whose merges cross words."""
    model = _model(path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in pieces):
        raise ValueError("this vocabulary merges across blanks; its counts do not add up by words")
    words = [p[1:] for p in pieces if p.startswith(BLANK) and len(p) > 1 and p[1] != BLANK]
    return [w for w, ids in zip(words, model.encode(words, num_threads=1)) if len(ids) == 1]


class _Counts(dict):
    """Segment without its first blank -> number of tokens."""

    def __init__(self, path: str, whole: list[str]):
        self.whole = {w: 1 for w in whole} | {"": 1}
        self.update(self.whole)
        self.encode = _model(path).encode

    def __missing__(self, segment: str) -> int:
        if len(self) >= MERGED_ENTRIES:
            self.clear()
            self.update(self.whole)
        n = len(self.encode(segment))
        self[segment] = n
        return n

    def of(self, text: str) -> int:
        if not text:
            return 0
        if BLANK in text:
            text = text.replace(BLANK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return sum([self[s[1:]] for s in _segments(" " + text)])
        return sum([self[w] for w in text.split(" ")])


def count_tokens(
    df: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit of every row; a null text is empty and has 0 tokens.

    No begin, end or added special tokens; strings that look like special tokens are ordinary text.
    """
    words = whole_tokens(path)

    def run(batches):
        counts = _Counts(path, words)
        for ids, texts in texts_of(batches):
            yield batch_of(
                _SCHEMA, [ids, [len(t.encode()) for t in texts], [counts.of(t) for t in texts]]
            )

    counted = small_batches(id_and_text(df, id_col, text_col)).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.selectExpr("*", f"n_tokens > {int(limit)} as over_limit")
