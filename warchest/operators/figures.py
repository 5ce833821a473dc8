"""Figures of a job that writes, taken while it writes.

Raw rows are counted below the roll-up, finished rows above it, per cycle, by ``DataFrame.observe``: the table is not read again.
Finished rows are counted in the stage that writes, once.  Raw rows are counted in an earlier stage; where Spark runs that again
after a lost executor they count again, so ``exclusion_audit`` stays the exact answer there.
"""

from __future__ import annotations

import logging
import threading
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..specs import DatasetSpec
from .clean import CYCLE, is_amended, is_memo
from .quality import EXTREME_AMOUNT

log = logging.getLogger(__name__)

RAW = ("input_rows", "memo_rows", "amended_rows")
FINISHED = ("row_count", "kept_rows", "extreme_rows", "nonpositive_rows")
COLUMNS = (*RAW, "duplicate_rows", *FINISHED)
SCHEMA = ", ".join(f"{c} bigint" for c in COLUMNS)


class Figures:
    """Counts per cycle of one write."""

    def __init__(self, spec: DatasetSpec, cycles: list[int]) -> None:
        self.spec, self.cycles = spec, sorted(cycles)
        self._raw, self._finished = (Observation(f"{kind}-{uuid.uuid4().hex}") for kind in ("raw", "finished"))

    def _observe(self, df: DataFrame, by: Observation, counts: dict[str, Column]) -> DataFrame:
        return df.observe(by, *[
            F.coalesce(F.sum(F.when(F.col(CYCLE) == c, value)), F.lit(0)).cast("bigint").alias(f"{name} {c}")
            for c in self.cycles for name, value in counts.items()])

    def raw(self, df: DataFrame) -> DataFrame:
        """Raw rows of a family that is rolled up."""
        memo, amended = is_memo(self.spec.memo), is_amended(self.spec.amendment)
        return self._observe(df, self._raw, {
            "input_rows": F.lit(1), "memo_rows": memo.cast("int"), "amended_rows": (~memo & amended).cast("int")})

    def finished(self, df: DataFrame) -> DataFrame:
        """Rows as they are written."""
        counts = {"row_count": F.lit(1)}
        if "total_amount" in df.columns:
            counts |= {"kept_rows": F.col("transaction_count"), "extreme_rows": (F.abs("total_amount") > EXTREME_AMOUNT).cast("int"),
                       "nonpositive_rows": (F.col("transaction_count") <= 0).cast("int")}
        return self._observe(df, self._finished, counts)

    def rows(self) -> dict[int, dict[str, int | None]]:
        """Per cycle, once the write is over: COLUMNS, None where the job did not tell."""
        seen = _told(self._raw) | _told(self._finished)
        out = {}
        for c in self.cycles:
            row = {name: seen.get(f"{name} {c}") for name in COLUMNS}
            if row["kept_rows"] is not None and row["input_rows"] is not None:
                row["duplicate_rows"] = row["input_rows"] - row["memo_rows"] - row["amended_rows"] - row["kept_rows"]
            out[c] = row
        return out


def _told(by: Observation, seconds: float = 5) -> dict[str, int]:
    """What was observed.  A plan that turned out empty may have dropped the observation; then nothing comes."""
    if by._jo is None:
        return {}
    found: dict[str, int] = {}

    def read() -> None:
        try:
            found.update(by.get)
        except Exception as error:  # noqa: BLE001 - a dropped observation is an error in some plans
            log.info("no figures: %s", error)

    reader = threading.Thread(target=read, daemon=True)
    reader.start()
    reader.join(seconds)
    return dict(found)
