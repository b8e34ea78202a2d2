"""Vector codes: every vector is cut into parts, each coded by its nearest entry in that part's codebook.

Components are integers, floor(``scale`` x), so sums, means and distances are exact and do not depend on how rows are
dealt. A part's codebook starts as that part of the vectors of the ``entries`` smallest ids; every round assigns all
parts to their nearest entry (squared Euclidean distance, ties to the lower index) and replaces an entry by the floored
mean of its parts. Every task adds up its parts per entry and sends only those sums.

*Memoised grid cells.* Space is cut into a grid of cubes. For the cube a part lies in, an entry whose smallest distance
to the cube exceeds another entry's largest distance can be nearest to no point of it; what is left, the entries not
dominated across the cube, is kept under the cube's coordinates and is the same for all parts in it. Only these entries
are evaluated exactly. The grid's edge follows the codebook: a quarter of the median distance between an entry and its
nearest other, per dimension. Bounds are rounded outwards, so the result is that of evaluating all entries. The cache of a task
is emptied when it holds ``CELLS`` cubes of a part; cubes are then computed again.

*Bounds.* The driver and each task hold the codebooks (entries x vector width numbers) and a round's sums, of the same
size. A task works on 512 rows at a time.

*Odd input.* Rows whose vector is null, empty, or holds a null, NaN or infinity are dropped, as are vectors of another
length than that of the smallest id. A length that does not divide by ``parts`` is filled up with zeros. Components
beyond +-2^50 after scaling count as +-2^50, errors beyond 2^63 - 1 as 2^63 - 1. Fewer vectors than ``entries`` make
fewer entries. Rows that repeat an id are coded each for itself and count as often; a null id is the largest; equal ids
start the codebook in the order of their vectors. A null label is a label. An empty table gives an empty result. Extra
columns are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import importable, pick, salted_join, slices, staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Cubes whose entries a task remembers, for each part.
CELLS = 1 << 15
LARGEST = 1 << 50


def usable(df: DataFrame, id_col: str, vector_col: str, label_col: str | None = None) -> DataFrame:
    """``id, vector`` (and ``label``) of the rows that can be coded."""
    rows = pick(df, id=id_col, vector=vector_col, **({"label": label_col} if label_col else {}))
    rows = rows.withColumn("vector", F.col("vector").cast("array<double>")).filter(
        (F.size("vector") > 0) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    first = rows.orderBy(F.asc_nulls_last("id"), "vector").select(F.size("vector")).first()
    return rows.filter(F.size("vector") == (first[0] if first else 0))


def part_matrices(vectors, parts: int, scale: int = SCALE) -> list:
    """The parts of an Arrow list array without nulls, as integer matrices of one row a vector."""
    import numpy as np
    x = np.asarray(vectors.flatten()).reshape(len(vectors), -1)
    with np.errstate(over="ignore"):
        x = np.clip(np.floor(x * scale), -LARGEST, LARGEST).astype(np.int64)
    return np.split(np.pad(x, ((0, 0), (0, -x.shape[1] % parts))), parts, axis=1)


class Nearest:
    """Finds the nearest entry of one codebook by remembered grid cells."""

    def __init__(self, entries, edge: int | None = None):
        import numpy as np
        self.entries, self.edge, self.cells = entries, edge or self.edge_of(entries), {}
        self.largest = int(np.abs(entries).max(initial=0))

    @staticmethod
    def edge_of(entries) -> int:
        import numpy as np
        e = np.unique(entries, axis=0).astype(np.float64)
        if len(e) < 2:
            return 1
        nearest = [np.partition(((e - x) ** 2).sum(1), 1)[1] for x in e]
        return max(1, int((np.median(nearest) / e.shape[1]) ** 0.5 / 4))

    def undominated(self, cells):
        """Which entries may be nearest to some point of each cell (rows of grid coordinates), as a mask.

        The spheres around the cells, whose distances are one matrix product, leave few entries to compare by box.
        """
        import numpy as np
        half = (self.edge - 1) / 2
        middle, entries = cells * float(self.edge) + half, self.entries.astype(np.float64)
        of_c, of_e = (middle ** 2).sum(1)[:, None], (entries ** 2).sum(1)[None, :]
        centre = np.sqrt(np.maximum(of_c + of_e - 2 * (middle @ entries.T), 0))
        rounding = 1e-6 * (np.sqrt(of_c) + np.sqrt(of_e.max()))
        cell, entry = np.nonzero(centre <= centre.min(1, keepdims=True) + 2 * half * cells.shape[1] ** 0.5 + rounding)
        off = np.abs(middle[cell] - entries[entry])
        most = ((off + half) ** 2).sum(1)
        least = (np.maximum(off - half, 0) ** 2).sum(1)
        limit = np.minimum.reduceat(most, np.searchsorted(cell, np.arange(len(cells))))
        keep = least <= limit[cell] * 1.0001  # outwards by far more than rounding
        mask = np.zeros((len(cells), len(entries)), dtype=bool)
        mask[cell[keep], entry[keep]] = True
        return mask

    def candidates(self, x):
        """Per row, a mask of the entries to evaluate."""
        import numpy as np
        grid = np.ascontiguousarray(x // self.edge)
        keys = grid.view(np.dtype((np.void, grid.itemsize * grid.shape[1]))).ravel()
        _, first, cell_of = np.unique(keys, return_index=True, return_inverse=True)
        names = [keys[i].tobytes() for i in first]
        new = [i for i, name in enumerate(names) if name not in self.cells]
        known = [self.cells.get(name) for name in names]
        if new:
            if len(self.cells) + len(new) > CELLS:
                self.cells.clear()
            masks = np.packbits(self.undominated(grid[first[new]]), axis=1)
            for i, mask in zip(new, masks):
                self.cells[names[i]] = known[i] = mask
        return np.unpackbits(np.stack(known), axis=1, count=len(self.entries)).view(bool)[cell_of]

    def __call__(self, x):
        """Index of the nearest entry and squared distance to it, for every row of ``x``."""
        import numpy as np
        span = 2 * max(self.largest, int(np.abs(x).max()))
        kind = np.float64 if span * span * x.shape[1] < 1 << 53 else object  # exact either way
        row, entry = np.nonzero(self.candidates(x))
        off = x.astype(kind)[row] - self.entries.astype(kind)[entry]
        distance = (off * off).sum(axis=1)
        starts = np.searchsorted(row, np.arange(len(x)))
        least = np.minimum.reduceat(distance, starts)
        hit = np.flatnonzero(distance == least[row])[::-1]  # backwards, so that the lowest index is set last
        best = np.empty(len(x), dtype=np.int64)
        best[row[hit]] = entry[hit]
        return best, least


def entry_sums(rows: DataFrame, books: list, scale: int = SCALE) -> DataFrame:
    """``slot, n, total``: per component of every entry that has parts, their number and the sum of the component.

    ``slot`` counts components through all codebooks, part by part and entry by entry.
    """
    importable(rows.sparkSession)
    m, width = books[0].shape

    def add(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        find = [Nearest(b) for b in books]
        total, n = np.zeros((len(books) * m, width), dtype=object), np.zeros(len(books) * m, dtype=np.int64)
        for batch in slices(batches):
            if not batch.num_rows:
                continue
            now = np.zeros((len(books) * m, width), dtype=np.int64)
            for p, x in enumerate(part_matrices(batch.column(0), len(books), scale)):
                best = find[p](x)[0] + p * m
                np.add.at(now, best, x)
                n += np.bincount(best, minlength=len(n))
            total += now
        used = np.flatnonzero(n)
        slot = (used[:, None] * width + np.arange(width)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(np.repeat(n[used], width)),
                                          pa.array([int(v) for v in total[used].ravel()], pa.decimal128(38, 0))], names=["slot", "n", "total"])
    made = rows.select("vector").mapInArrow(add, "slot long, n long, total decimal(38,0)")
    return made.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))


def train_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> list:
    """The codebooks, one integer matrix of entries a part, after ``rounds`` rounds over all of ``rows``."""
    import numpy as np
    import pyarrow as pa
    start = rows.orderBy(F.asc_nulls_last("id"), "vector").select("vector").limit(entries).collect()
    if not start:
        return []
    books = part_matrices(pa.array([r["vector"] for r in start], pa.list_(pa.float64())), parts, scale)
    for _ in range(rounds):
        m, width = books[0].shape
        flat = np.concatenate([b.ravel() for b in books])
        for r in entry_sums(rows, books, scale).collect():  # at most a row per component of the codebooks
            flat[r["slot"]] = int(r["total"]) // r["n"]
        books = list(flat.reshape(parts, m, width))
    return books


def encode(rows: DataFrame, books: list, scale: int = SCALE) -> DataFrame:
    """``rows`` without the vector, with ``code`` (two hex digits a part) and ``error``, the summed squared distances."""
    importable(rows.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    kept = [f for f in rows.schema if f.name != "vector"]
    schema = rows.select(*[f.name for f in kept], F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).schema
    names = to_arrow_schema(schema).names

    def code(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        find = [Nearest(b) for b in books]
        for batch in slices(batches):
            if not batch.num_rows:
                continue
            found = [f(x) for f, x in zip(find, part_matrices(batch.column(batch.schema.get_field_index("vector")), len(books), scale))]
            text = np.stack([best for best, _ in found], axis=1).astype(np.uint8).tobytes().hex()
            error = [min(int(e), (1 << 63) - 1) for e in sum(least.astype(object) for _, least in found)]
            wide = 2 * len(books)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(f.name)) for f in kept] + [
                pa.array([text[i:i + wide] for i in range(0, len(text), wide)], pa.string()), pa.array(error, pa.int64())], names=names)
    return rows.mapInArrow(code, schema)


def codebooks_digest(books: list) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def vector_codes(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
                 entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``id, label, code, error, label_error, codebooks_sha256`` of every usable row; at most 256 entries.

    ``label_error`` is the error summed over rows of the same label.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits hold 256 entries")
    rows = usable(df, id_col, vector_col, label_col)
    books = train_codebooks(rows.select("id", "vector"), parts, entries, rounds, scale)
    coded = staged(encode(rows, books, scale).withColumns({
        "no_label": F.col("label").isNull(), "some_label": F.coalesce(F.col("label").cast("string"), F.lit(""))}), "codes")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    sums = coded.groupBy("no_label", "some_label").agg(F.least(F.sum(F.col("error").cast("decimal(20,0)")).cast("decimal(38,0)"), most)
                                                       .cast("long").alias("label_error"))
    return salted_join(coded, sums, ["no_label", "some_label"], F.col("id")) \
        .select("id", "label", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
