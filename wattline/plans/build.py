"""What one run passes to every model: its id, its time and its environment."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from wattline.functions import load_audit_columns


@dataclass(frozen=True)
class Build:
    run_id: str
    as_of: datetime
    environment: str = "dev"

    def stamp(self, df: DataFrame) -> DataFrame:
        return load_audit_columns(df, self.as_of, self.run_id)
