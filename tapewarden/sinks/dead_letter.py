"""Rejected trades as CSV with a fixed column order."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tapewarden.schema import DEAD_LETTER_COLUMNS


def write_dead_letters(
    rejected: DataFrame, path: str, batch_id: int | None = None, writer: str = "main"
) -> None:
    """Append rejected rows.

    A batch of a stream replaces its own folder, so a replay adds nothing.
    """
    rows = rejected.select(*DEAD_LETTER_COLUMNS)
    if batch_id is None:
        rows.write.mode("append").option("header", True).csv(path)
    else:
        folder = f"{path}/writer={writer}/batch_id={batch_id}"
        rows.write.mode("overwrite").option("header", True).csv(folder)
