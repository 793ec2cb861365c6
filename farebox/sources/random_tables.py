"""Columns drawn from distributions, one value per row of a table."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.registry import query
from farebox.tables import Tables


def draw_discrete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Poisson and gamma values; the generator is seeded by the batch's first key, so a retry draws the same."""
    for batch in batches:
        if len(batch):
            rng = np.random.default_rng([2024, int(batch["o_orderkey"].iloc[0])])
            yield batch.assign(poisson=rng.poisson(4.0, len(batch)), gamma=rng.gamma(2.0, 3.0, len(batch)))


@query("src_random_tables")
def src_random_tables(t: Tables) -> DataFrame:
    """Uniform, normal, log-normal, exponential, Poisson and gamma columns over orders."""
    drawn = t.orders.select(
        "o_orderkey",
        F.rand(1).alias("uniform"),
        F.randn(2).alias("normal"),
        F.exp(F.randn(3) * 0.5 + 1).alias("log_normal"),
        (-F.log1p(-F.rand(4)) * 2.0).alias("exponential"),
    )
    return drawn.mapInPandas(draw_discrete, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in drawn.schema)}, poisson bigint, gamma double")
