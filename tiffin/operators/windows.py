"""Overlapping windows of long texts, cut at sentence ends where there is one, with the places they were cut."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A sentence ends behind a full stop, exclamation or question mark and one blank, or behind a line feed.
SENTENCE_END = r"(?s)^.*(?:[.!?][ \t\r]|\n)"


@dataclass(frozen=True)
class Windows:
    """Sizes in characters (code points).

    Window k is planned for ``[k * step, k * step + size)``, ``step = size - overlap``. Each end is moved back behind
    the last sentence end among the ``slack`` characters before it, if there is one; the start of a text and its end
    stay. As slack is at most overlap, every character is in a window, and as it is less than step, windows go forward.
    """

    size: int = 1000
    overlap: int = 200
    slack: int = 150

    def __post_init__(self) -> None:
        if not 0 <= self.slack <= self.overlap < self.size or self.slack >= self.step:
            raise ValueError("sizes must hold 0 <= slack <= overlap < size and slack < size - overlap")

    @property
    def step(self) -> int:
        return self.size - self.overlap


def _cut(window: Column, upto: int, slack: int) -> Column:
    """Characters of ``window`` before its cut, which is planned behind ``upto`` characters."""
    tail = F.substring(window, upto - slack + 1, slack)
    return F.lit(upto - slack) + F.when(
        tail.rlike(SENTENCE_END), F.length(F.regexp_extract(tail, SENTENCE_END, 0))
    ).otherwise(F.lit(slack))


def text_windows(df: DataFrame, text: str = "text", windows: Windows | None = None) -> DataFrame:
    """The rows once per window, with ``window_no`` from 0, ``window_start``, ``window_end`` (offsets in the whole
    text, the end exclusive) and ``window_text``, in place of the text.

    A text is split into pieces of one step in a single pass, and a window looks at the few pieces around it, so the
    work grows with the text and not with its square. A missing text has no window, an empty one a single empty
    window. Columns named like the new ones are replaced.
    """
    w = windows or Windows()
    step, size, slack = w.step, w.size, w.slack
    reach = -(-size // step)  # pieces from the planned start to the planned end
    names = ("window_no", "window_start", "window_end", "window_text")
    kept = [c for c in df.columns if c not in (text, *names)]
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    cut = df.filter(F.col(text).isNotNull()).select(
        *kept, F.length(text).alias("_length"), pieces.alias("_pieces")
    )
    # The last window is the first one whose planned end reaches the end of the text.
    count = F.greatest(F.lit(1), F.ceil((F.col("_length") - w.overlap) / step).cast("int"))
    around = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda k: F.struct(
            k.alias("no"),
            # The piece before the window too: its start may move back into it.
            F.array_join(F.slice("_pieces", F.greatest(k, F.lit(1)), F.lit(reach + 1)), "").alias("near"),
        ),
    )
    rows = cut.select(*kept, "_length", F.explode(around).alias("_w")).select(
        *kept, "_length", F.col("_w.no").alias("_no"), F.col("_w.near").alias("_near"),
        F.when(F.col("_w.no") > 0, step).otherwise(0).alias("_lead"),
    )
    start = F.when(F.col("_no") > 0, _cut(F.col("_near"), step, slack)).otherwise(0)
    planned_end = F.col("_no") * step + size
    end = (
        F.when(planned_end >= F.col("_length"), F.col("_length") - F.col("_no") * step + F.col("_lead"))
        .when(F.col("_no") > 0, _cut(F.col("_near"), step + size, slack))
        .otherwise(_cut(F.col("_near"), size, slack))
    )
    base = F.col("_no") * step - F.col("_lead")
    placed = rows.withColumns({"_from": start, "_to": end})
    return placed.select(
        *kept,
        F.col("_no").alias("window_no"),
        (base + F.col("_from")).cast("int").alias("window_start"),
        (base + F.col("_to")).cast("int").alias("window_end"),
        F.substring("_near", F.col("_from") + 1, F.col("_to") - F.col("_from")).alias("window_text"),
    )
