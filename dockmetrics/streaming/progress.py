"""A log line per micro-batch."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

logger = logging.getLogger(__name__)


def counted(df: DataFrame, name: str) -> DataFrame:
    """The same rows; their number per batch is reported under ``name``."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


class ProgressLog(StreamingQueryListener):
    """Logs what each batch read and what ``counted`` saw of it."""

    def onQueryStarted(self, event) -> None:
        logger.info("%s started", event.name or event.id)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = {name: row.asDict() for name, row in progress.observedMetrics.items()}
        logger.info(
            "%s batch %d: %d input rows, %s",
            progress.name or progress.id,
            progress.batchId,
            progress.numInputRows,
            seen,
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        logger.info("%s ended: %s", event.id, event.exception or "stopped")
