"""Small random bars for tests, in pandas."""

import numpy as np
import pandas as pd

COLUMNS = ["Symbol", "Date", "Open", "High", "Low", "Close", "Volume", "OpenInt"]


def random_bars(lengths: dict[str, int], seed: int = 1) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    frames = []
    for symbol, n in lengths.items():
        close = 50 * np.exp(np.cumsum(rng.normal(0, 0.02, n)))
        open_ = close * np.exp(rng.normal(0, 0.01, n))
        frames.append(pd.DataFrame({
            "Symbol": symbol,
            "Date": pd.Timestamp("2014-06-01") + pd.to_timedelta(
                np.cumsum(rng.integers(1, 4, n)), "D"),
            "Open": open_, "High": np.maximum(open_, close) * 1.01,
            "Low": np.minimum(open_, close) * 0.99, "Close": close,
            "Volume": np.where(rng.random(n) < 0.05, 0.0, rng.integers(1, 1000, n) * 1.0),
            "OpenInt": 0.0,
        }))
    return pd.concat(frames, ignore_index=True)[COLUMNS]


def frame(spark, pdf: pd.DataFrame):
    return spark.createDataFrame(pdf)


def rows(df, *keys: str) -> pd.DataFrame:
    return df.toPandas().sort_values(list(keys)).reset_index(drop=True)
