"""Near-duplicate vectors by product quantisation.

A coarse quantiser deals unit vectors into inverted lists; what a vector differs from its list's
centre is coded per subspace. Both are fitted on a bounded sample, every vector is indexed. A
vector looks into the ``PROBES`` lists with the nearest centres. There its distances to the coded
vectors are sums of table entries; since the coding error of each vector is stored, a sum above
the threshold plus that error proves that the pair is too far apart. The rest is compared by exact
cosine in double precision.

Equal vectors of a label are one class. Lists are dealt out in blocks of at most ``BLOCK`` coded
vectors and ``BLOCK`` searching ones, so a list that holds a third of all vectors is many tasks; a
block gives link counts and a spanning forest of its links, never the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitrank.llm.common import shuffle_partitions
from traitrank.llm.components import components, spanning_forest
from traitrank.sources.staging import Staging

THRESHOLD = 0.93
# Vectors that the quantisers are fitted on at most, chosen by a hash of the id.
SAMPLE = 16_384
# Vectors per label and list that are aimed at, and the most lists, which bounds the codebook.
PER_LIST = 256
MOST_LISTS = 4096
LEAST_LISTS = 24
PROBES = 10
SUBSPACES = 8
CODES = 64
BLOCK = 1024
_ROUNDS = 8
# Slack for single precision in the table sums.
_SLACK = 1e-3


def _kmeans(rows: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    k = max(1, min(k, len(rows)))
    centres = rows[rng.choice(len(rows), k, replace=False)].copy()
    for _ in range(_ROUNDS):
        own = _nearest(rows, centres, 1)[:, 0]
        counts = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """The k nearest centres of each row, nearest first, ties by number."""
    out = []
    for start in range(0, len(rows), 4096):
        part = rows[start : start + 4096]
        far = (centres**2).sum(axis=1) - 2 * part @ centres.T
        out.append(np.argsort(far, axis=1, kind="stable")[:, :k])
    return np.concatenate(out) if out else np.zeros((0, k), np.int64)


@dataclass
class Quantiser:
    """``MOST_LISTS`` centres and ``SUBSPACES * CODES`` code words at most, whatever the input."""

    centres: np.ndarray
    words: list[np.ndarray]  # for each subspace: codes x its dimensions
    cuts: list[slice]

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int) -> "Quantiser":
        rng = np.random.default_rng(0)
        centres = _kmeans(sample, lists, rng)
        rest = sample - centres[_nearest(sample, centres, 1)[:, 0]]
        bounds = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
        cuts = [slice(a, b) for a, b in zip(bounds, bounds[1:])]
        return cls(centres, [_kmeans(rest[:, c], CODES, rng) for c in cuts], cuts)

    def encode(self, unit: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code per subspace and distance of the coded vector from the vector."""
        rest = unit - self.centres[own]
        codes = np.stack([_nearest(rest[:, c], w, 1)[:, 0] for c, w in zip(self.cuts, self.words)], axis=1)
        coded = np.concatenate([w[codes[:, k]] for k, w in enumerate(self.words)], axis=1)
        return codes.astype(np.uint8), np.linalg.norm(rest - coded, axis=1)

    def tables(self, unit: np.ndarray, listed: int) -> list[np.ndarray]:
        """Squared distances of searching vectors to all code words of a list, per subspace."""
        rest = unit - self.centres[listed]
        return [((rest[:, c][:, None, :] - w) ** 2).sum(axis=2) for c, w in zip(self.cuts, self.words)]


def _units(vectors: pd.Series) -> list[np.ndarray]:
    """Unit vectors in double precision. The vectors are finite and have a component that is not 0."""
    out = []
    for v in vectors:
        x = np.asarray(v, dtype=np.float64)
        x = x / np.abs(x).max()
        out.append(x / np.linalg.norm(x))
    return out


def _first(units: list[np.ndarray], dims: int) -> np.ndarray:
    """The first ``dims`` components of each, zeros where there are fewer.

    Two vectors of one length are at least as far apart as these are, so what the quantiser proves
    of these holds for the vectors.
    """
    rows = np.zeros((len(units), dims), np.float32)
    for row, unit in zip(rows, units):
        row[: len(unit)] = unit[:dims]
    return rows


def _index(shared, dims: int):
    """Per vector: unit vector, own list, lists to look into, codes, coding error."""

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        book = shared.value
        for batch in batches:
            if not len(batch):
                continue
            unit = _units(batch["embedding"])
            single = _first(unit, dims)
            probes = _nearest(single, book.centres, PROBES)
            codes, error = book.encode(single, probes[:, 0])
            yield pd.DataFrame({
                "node": batch["node"].to_numpy(), "label": batch["label"].to_numpy(),
                "length": np.array([len(u) for u in unit], np.int32), "copies": batch["copies"].to_numpy(),
                "unit": [u.tobytes() for u in unit], "own": probes[:, 0].astype(np.int32),
                "probes": [p.astype(np.int32) for p in probes],
                "codes": [c.tobytes() for c in codes], "error": error.astype(np.float32),
            })

    return index


_INDEX = "node long, label int, length int, copies long, unit binary, own int, probes array<int>, codes binary, error float"
# Vectors of a label and length in a list meet.
_LIST = ["label", "length", "list"]
_FOUND = "node long, links long, a long, b long"


def _search(shared, threshold: float):
    """Link counts and a spanning forest of one block of a list.

    A pair that both vectors would find is counted where the searching one looks; one that only
    the searching vector finds is counted for the coded one as well.
    """
    reach = (2 - 2 * threshold) ** 0.5

    def search(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        listed = int(key[2])
        coded, asking = block[block["coded"]], block[~block["coded"]]
        nothing = pd.DataFrame({"node": [], "links": [], "a": [], "b": []}).astype("Int64")
        if not len(coded) or not len(asking):
            return nothing
        book = shared.value
        x, y = (np.frombuffer(b"".join(d["unit"]), np.float64).reshape(len(d), -1) for d in (asking, coded))
        codes = np.frombuffer(b"".join(coded["codes"]), np.uint8).reshape(len(coded), -1)
        limit = (reach + coded["error"].to_numpy().astype(np.float64) + _SLACK) ** 2
        near = np.zeros((len(x), len(y)), np.float32)
        for k, table in enumerate(book.tables(_first(list(x), book.centres.shape[1]), listed)):
            near += table.astype(np.float32)[:, codes[:, k]]
        i, j = np.nonzero(near <= limit)
        nodes_x, nodes_y = asking["node"].to_numpy(), coded["node"].to_numpy()
        other = nodes_x[i] != nodes_y[j]
        i, j = i[other], j[other]
        linked = np.zeros(len(i), bool)
        for s in range(0, len(i), 1 << 16):
            part = slice(s, s + (1 << 16))
            linked[part] = np.einsum("ij,ij->i", x[i[part]], y[j[part]]) >= threshold
        i, j = i[linked], j[linked]
        if not len(i):
            return nothing
        own_x, probes_y = asking["own"].to_numpy(), np.stack(coded["probes"].to_list())
        one_way = (probes_y[j] != own_x[i][:, None]).all(axis=1)
        copies_x, copies_y = asking["copies"].to_numpy(), coded["copies"].to_numpy()
        links_x = np.bincount(i, copies_y[j], len(x))
        links_y = np.bincount(j[one_way], copies_x[i[one_way]], len(y))
        nodes, at = np.unique(np.concatenate([nodes_x, nodes_y]), return_inverse=True)
        label = spanning_forest(len(nodes), at[i], at[len(x) + j])
        tied = np.flatnonzero(label != np.arange(len(nodes)))
        counted = pd.DataFrame({"node": np.concatenate([nodes_x, nodes_y]), "links": np.concatenate([links_x, links_y])})
        edges = pd.DataFrame({"a": nodes[tied], "b": nodes[label[tied]]})
        return pd.concat([counted[counted["links"] > 0], edges])[["node", "links", "a", "b"]].astype("Int64")

    return search


def vector_classes(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``vectors``.

    ``n_links`` counts the other vectors of the same label found with a cosine of at least
    ``threshold``; ``component_id`` is the smallest id reachable over links; ``kept`` says that
    it is the row's own. Vectors that are null, zero, hold null or non-finite components, have
    or no label link with nothing, and vectors of different lengths do not link.
    Rows that repeat an id count as vectors. A row without id links with nothing and has no component. An empty
    table gives an empty result; further columns are not looked at.
    """
    spark, staging = vectors.sparkSession, Staging.of(vectors)
    given = vectors.select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("int").alias("label"), F.col(vector).alias("embedding")
    )
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = given.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & finite
    ).withColumn("embedding", F.transform("embedding", lambda x: x.cast("double") + 0.0))
    usable = usable.filter(F.exists("embedding", lambda x: x != 0))
    classes = staging.write(
        usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")), "vectors"
    )
    sample = (
        classes.select("node", "embedding").orderBy(F.xxhash64("node"), "node").limit(SAMPLE).toPandas()["embedding"]
    )
    rows = given.select("vec_id", "label", "embedding")
    alone = rows.select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
        F.col("vec_id").isNotNull().alias("kept"),
    )
    if not len(sample):
        return alone
    # Most vectors have one length; the quantiser sees as many components of the others.
    dims = int(sample.map(len).mode()[0])
    n, labels = classes.agg(F.count(F.lit(1)), F.count_distinct("label")).first()
    lists = max(LEAST_LISTS, min(MOST_LISTS, n // (PER_LIST * labels)))
    shared = spark.sparkContext.broadcast(Quantiser.fit(_first(_units(sample), dims), lists))
    indexed = staging.write(
        classes.repartition(shuffle_partitions(spark)).mapInPandas(_index(shared, dims), _INDEX), "index"
    )

    # Blocks per list: of its coded vectors, and of the vectors that look into it.
    looks = indexed.withColumn("list", F.explode("probes"))
    own_counts = indexed.groupBy("label", "length", F.col("own").alias("list")).agg(F.count(F.lit(1)).alias("n_coded"))
    ask_counts = looks.groupBy("label", "length", "list").agg(F.count(F.lit(1)).alias("n_asking"))
    blocks = own_counts.join(ask_counts, _LIST).select(
        *_LIST,
        F.ceil(F.col("n_coded") / BLOCK).cast("int").alias("coded_blocks"),
        F.ceil(F.col("n_asking") / BLOCK).cast("int").alias("asking_blocks"),
    )

    def dealt(side: DataFrame, coded: bool) -> DataFrame:
        mine, others = ("coded", "asking") if coded else ("asking", "coded")
        met = side.join(blocks, _LIST).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col(f"{others}_blocks") - 1)))
        place = F.pmod(F.xxhash64("node"), F.col(f"{mine}_blocks")).cast("int")
        at, to = (place, F.col("copy")) if coded else (F.col("copy"), place)
        return met.select(
            *_LIST, at.alias("coded_block"), to.alias("asking_block"), F.lit(coded).alias("coded"),
            "node", "copies", "unit", "own", "probes", "codes", "error",
        )

    both = dealt(indexed.withColumn("list", F.col("own")), True).unionByName(dealt(looks, False))
    found = staging.write(
        both.groupBy(*_LIST, "coded_block", "asking_block").applyInPandas(_search(shared, threshold), _FOUND), "found"
    )
    links = found.filter("node IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.filter("a IS NOT NULL").select("a", "b"), staging)
    known = (
        classes.join(links.hint("merge"), "node", "left").join(joined.hint("merge"), "node", "left")
        .select(
            "label", "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    linked = usable.join(known.hint("merge"), ["label", "embedding"]).select(
        "vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"),
        (F.col("vec_id") == F.col("component")).alias("kept"),
    )
    has_vector = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & finite
    rest = rows.filter(~F.coalesce(has_vector & F.exists("embedding", lambda x: x != 0), F.lit(False)))
    return linked.unionByName(
        rest.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
            F.col("vec_id").isNotNull().alias("kept"),
        )
    )
