"""Token counts by a sentence-piece vocabulary, with a shortcut for strings that are one token.

BPE merges never cross a place that no vocabulary entry crosses. ``PieceCounter`` proves from the
vocabulary, before any text is read, that (1) no entry has a space mark after another character, so a
text falls apart before each run of spaces, (2) no entry holds a line feed, which is a token of its own,
and (3) which entries encode alone as one token. A pre-token among those counts as one; only the rest
are merged, once per worker and distinct pre-token.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewarden.llm.common import Memo, append_columns

MARK = "▁"  # how the library writes a space inside pieces
LIMIT = 4096


class PieceCounter:
    """Counts tokens of whole texts as ``SentencePieceProcessor.encode`` does."""

    def __init__(self, model_path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        model = self.model
        usual = [
            model.id_to_piece(i)
            for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in usual) or len(model.encode("\n")) != 2 or len(model.encode("\n \n")) != 4:
            raise ValueError("this vocabulary merges across spaces or line ends")
        self.whole = frozenset(p for p in usual if self._merged(p) == 1)
        self.memo = Memo(lambda p: 1 if p in self.whole else self._merged(p))
        self.cut = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")

    def _merged(self, part: str) -> int:
        """Tokens of a pre-token: a line feed before it keeps the library's own leading space away."""
        return len(self.model.encode("\n" + part.replace(MARK, " "))) - 2

    def count(self, text: str) -> int:
        if not text:
            return 0
        parts = self.cut.findall(MARK + text.replace(" ", MARK))
        return sum(map(self.memo.__getitem__, parts))


@functools.lru_cache(maxsize=1)
def counter(model_path: str) -> PieceCounter:
    return PieceCounter(model_path)


def count_tokens(docs: DataFrame, model_path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """All columns of ``docs`` with n_bytes, n_tokens and over_limit (more than ``limit`` tokens).

    Whole texts are counted; null counts as empty (0 bytes, 0 tokens). Rows are neither moved nor
    dropped, so repeated rows and an empty table need no care. ``docs`` must not have these columns yet.
    """

    def compute(texts: list[bytes]) -> dict[str, pa.Array]:
        count = counter(model_path).count
        return {"n_tokens": pa.array([count(x.decode()) for x in texts], pa.int64())}

    if taken := {"n_bytes", "over_limit"} & set(docs.columns):
        raise ValueError(f"the input already has {', '.join(sorted(taken))}")
    counted = append_columns(docs, text, "n_tokens bigint", compute)
    return counted.withColumns(
        {
            "n_bytes": F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint"),
            "over_limit": F.col("n_tokens") > limit,
        }
    )
