"""Barcode matching over a stream, with the position prior as keyed state.

Reads are dealt to lanes by a hash of their name; each lane learns its own prior, so lanes run side by side and any
number of them can be used.  A lane's state is three numbers (matches, sum and sum of squares of their starts) in the
state store, which commits them with the micro-batch: a batch costs the same however long the stream has run, and a
restarted stream goes on from where it was.  Inside a lane the window is learnt anew after every
``cfg.batch`` texts, as the sequential matcher does; texts of a micro-batch are taken in the order of their names.
"""

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from isoquilt.config import BarcodeConfig
from isoquilt.functions import stats
from isoquilt.functions.align import infix_batch
from isoquilt.functions.kmer_numbers import Index
from isoquilt.operators.barcode import BROADCAST_BARCODES, window_bounds
from isoquilt.session import ordinal, running_totals

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MATCHES = "lane int, read_name string, barcode string, start double, edit int, n long, mu double, sigma double"
PRIORS = "lane int, n long, mu double, sigma double"


def prior(n: int, s: float, q: float, cfg: BarcodeConfig) -> tuple[float, float]:
    """Mean and width of the start position after ``n`` matches with sum ``s`` and sum of squares ``q``."""
    if n < 2:
        return cfg.mu, cfg.sigma
    mean = s / n
    var = max(0.0, (q - n * mean * mean) / (n - 1))
    return mean, max(math.sqrt(var * (n + 1) / (n + 0.5)) + cfg.sigma_start / n, 1e-3)


def match_texts(texts: pd.DataFrame, index: Index, names: np.ndarray, mu: float, sigma: float, cfg: BarcodeConfig) -> pd.DataFrame:
    """Best barcode of each of (read_name, seq): what ``barcode.best_match`` gives for the same window."""
    low, high = window_bounds(mu, sigma, cfg)
    length = texts["seq"].str.len()
    part = texts["seq"].str.slice(int(low), int(low) + int(high - low + 1))
    fits = (length >= low + cfg.barcode_len - 1) & (part.str.len() >= cfg.barcode_len)
    window = pd.DataFrame({"read_name": texts["read_name"], "seq": part})[fits].drop_duplicates(ignore_index=True)
    none = pd.DataFrame({"read_name": [], "barcode": [], "start": [], "edit": []})
    if window.empty:
        return none
    row, bar, cos = index.similar(window["seq"], cfg.cos_thresh)
    pairs = pd.DataFrame({"row": row, "barcode": names[bar], "cos": cos}).sort_values(["row", "cos", "barcode"], ascending=[True, False, True])
    pairs["rank"] = pairs.groupby("row").cumcount() + 1
    pairs = pairs[pairs["rank"] <= cfg.top].reset_index(drop=True)
    if pairs.empty:
        return none
    pairs["edit"], pairs["pos"] = infix_batch(window["seq"].iloc[pairs["row"]].reset_index(drop=True), pairs["barcode"])
    pairs = pairs[(pairs["edit"] < cfg.barcode_len) & (pairs["edit"] <= cfg.max_edit)]
    pairs = pairs.assign(far=(pairs["pos"] - mu).abs()).sort_values(["row", "edit", "far", "rank", "barcode", "pos"]).drop_duplicates("row")
    return pd.DataFrame({
        "read_name": window["read_name"].iloc[pairs["row"]].to_numpy(), "barcode": pairs["barcode"].to_numpy(),
        "start": low + pairs["pos"].to_numpy(), "edit": pairs["edit"].to_numpy(),
    })


class _Sums(StatefulProcessor):
    """State of a lane: count, sum and sum of squares."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", "n bigint, s double, q double")

    def load(self) -> tuple[int, float, float]:
        return tuple(self.sums.get()) if self.sums.exists() else (0, 0.0, 0.0)

    def close(self) -> None:
        pass


@lru_cache(maxsize=2)
def _index(packed: bytes, k: int) -> tuple[Index, np.ndarray]:
    """The index of a packed whitelist; a worker builds it once and keeps it over its batches."""
    names = zlib.decompress(packed).decode().split("\n")
    return Index(names, k), np.array(names, dtype=object)


class Matcher(_Sums):
    def __init__(self, packed: bytes, cfg: BarcodeConfig):
        self.packed, self.cfg = packed, cfg

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        index, names = _index(self.packed, self.cfg.k)
        n, s, q = self.load()
        texts = pd.concat(list(rows)).sort_values(["read_name", "seq"], ignore_index=True)
        for at in range(0, len(texts), self.cfg.batch):
            mu, sigma = prior(n, s, q, self.cfg)
            found = match_texts(texts.iloc[at : at + self.cfg.batch].reset_index(drop=True), index, names, mu, sigma, self.cfg)
            found = found.assign(lane=key[0], n=n, mu=mu, sigma=sigma)
            n, s, q = n + len(found), s + float(found["start"].sum()), q + float((found["start"] ** 2).sum())
            if len(found):
                yield found[["lane", "read_name", "barcode", "start", "edit", "n", "mu", "sigma"]]
        self.sums.update((n, s, q))


class Learner(_Sums):
    def __init__(self, cfg: BarcodeConfig):
        self.cfg = cfg

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n, s, q = self.load()
        values = pd.concat(list(rows)).sort_values("place")["value"].to_numpy(dtype=float)
        out, at = [], 0
        while at < len(values):
            part = values[at : at + self.cfg.batch - n % self.cfg.batch]
            n, s, q, at = n + len(part), s + float(part.sum()), q + float((part**2).sum()), at + len(part)
            if n % self.cfg.batch == 0:
                out.append((key[0], n, *prior(n, s, q, self.cfg)))
        self.sums.update((n, s, q))
        yield pd.DataFrame(out, columns=["lane", "n", "mu", "sigma"])


def _stateful(rows: DataFrame, processor: StatefulProcessor, schema: str) -> DataFrame:
    # read when the stream starts; only this store keeps keyed state of this kind
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return rows.groupBy("lane").transformWithStateInPandas(processor, schema, "Append", "None")


def _started(out: DataFrame, path: str, checkpoint: str):
    sink = out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return sink.outputMode("append").trigger(availableNow=True).start()


def match_stream(reads: DataFrame, whitelist: DataFrame, out: str, checkpoint: str, cfg: BarcodeConfig = BarcodeConfig(), lanes: int = 64):
    """Start matching a stream of (read_name, seq) into ``out``/matches; returns the streaming query.

    A match comes with the prior it was found under and the matches ``n`` its lane had then.  The whitelist
    goes to every task, packed to about a third, so its size is checked.  ``lanes`` must stay the same over restarts.
    """
    names = sorted(r["barcode"] for r in whitelist.distinct().limit(BROADCAST_BARCODES + 1).collect())
    if len(names) > BROADCAST_BARCODES:
        raise ValueError(f"a stream holds whitelists of up to {BROADCAST_BARCODES} barcodes; barcode.match_barcodes takes any size")
    packed = zlib.compress("\n".join(names).encode())
    lane = F.pmod(F.xxhash64("read_name"), F.lit(lanes)).cast("int").alias("lane")
    return _started(_stateful(reads.select(lane, "read_name", "seq"), Matcher(packed, cfg), MATCHES), f"{out}/matches", checkpoint)


def prior_stream(values: DataFrame, out: str, checkpoint: str, cfg: BarcodeConfig = BarcodeConfig()):
    """Start a stream of (lane, place, value) that writes each lane's prior after every ``cfg.batch`` values to ``out``."""
    rows = values.select(F.col("lane").cast("int"), "place", F.col("value").cast("double").alias("value"))
    return _started(_stateful(rows, Learner(cfg), PRIORS), out, checkpoint)


def learnt_priors(values: DataFrame, order: list, column: str, cfg: BarcodeConfig = BarcodeConfig()) -> DataFrame:
    """The prior after each batch of ``cfg.batch`` values, as the sequential matcher would hold it."""
    numbered = ordinal(values.select(*order, column), order, "place")
    batches = numbered.groupBy(F.floor((F.col("place") - 1) / cfg.batch).alias("batch")).agg(
        F.count("*").alias("c"), F.sum(column).alias("s"), F.sum(F.col(column) * F.col(column)).alias("q")
    )
    run = running_totals(batches, ["batch"], {"n": "c", "sum_x": "s", "sum_sq": "q"})
    mean = F.col("sum_x") / F.col("n")
    var = (F.col("sum_sq") - F.col("n") * mean * mean) / (F.col("n") - 1)
    return run.select("batch", "n", mean.alias("mu"), stats.updated_sigma(var, F.col("n"), cfg.sigma_start).alias("sigma"))
