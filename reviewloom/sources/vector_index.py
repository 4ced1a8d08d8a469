"""A vector index kept in the session catalog: built once, appended to, split, searched by any session.

Three tables hold it. ``_rows`` has the vectors, partitioned by cell; ``_cells`` has one row for each
cell made and one for each cell given up, so the cells in force are those not given up; ``_sizes``
has, for each load, how many rows it brought to a cell and how near and far from its pivot they lie.
Loads only append, and what a search reads of a cell is its partition alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.operators import vectors as V
from reviewloom.session import materialize
from reviewloom.sources.collections import DATABASE, _ensure_database

ROWS_A_CELL = 100_000


class _Stored(V.Cells):
    """The cells in force as the search kernel wants them; rows are read by partition."""

    def __init__(self, index: VectorIndex) -> None:
        self.dim = index.dim()
        self.ids, self.pivots = index.pivots()
        self.rows = index.rows()
        sizes = {
            r["cell"]: r
            for r in index.spark.table(index.name("sizes"))
            .groupBy("cell")
            .agg(F.sum("n").alias("n"), F.min("r_min").alias("r_min"), F.max("r_max").alias("r_max"))
            .collect()  # one row a cell
        }
        self.cell = np.array([i for i, c in enumerate(self.ids) if c in sizes], np.int64)
        known = [sizes[self.ids[i]] for i in self.cell]
        self.n = np.array([r["n"] for r in known], np.int64)
        self.r_min = np.array([r["r_min"] for r in known], np.float64)
        self.r_max = np.array([r["r_max"] for r in known], np.float64)
        self.blocks = -(-self.n // V.BLOCK_ROWS)

    def blocked(self, only: list[int] | None = None) -> DataFrame:
        """Rows of some cells, of which no other partition is read, with their block."""
        wanted = set(self.cell.tolist() if only is None else only)
        table = [
            (int(c), int(self.ids[c]), int(b)) for c, b in zip(self.cell, self.blocks, strict=True) if int(c) in wanted
        ]
        if not table:
            table = [(-1, -1, 1)]
        places = self.rows.sparkSession.createDataFrame(table, "place int, cell bigint, blocks bigint")
        all_cells = len(table) == len(self.cell)  # a list of them says nothing that the rows in force do not
        read = self.rows if all_cells else self.rows.filter(F.col("cell").isin([c for _, c, _ in table]))
        # one row a cell, whose number is bounded by the size of the pivots
        return read.join(F.broadcast(places), "cell").select(
            "id", "vec", F.col("place").alias("cell"), F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block")
        )


class VectorIndex:
    """One index by name; nothing but its tables is kept, so any session with the catalog can use it."""

    def __init__(self, spark: SparkSession, name: str, database: str = DATABASE) -> None:
        self.spark, self._name = spark, f"{database}.{name}"
        _ensure_database(spark, database)

    def name(self, part: str) -> str:
        return f"{self._name}_{part}"

    def rows(self) -> DataFrame:
        """All rows in force: (id, vec, r, cell)."""
        return self.spark.table(self.name("rows")).filter(F.col("cell").isin(self.pivots()[0]))

    def dim(self) -> int:
        shown = self.spark.sql(f"SHOW TBLPROPERTIES {self.name('cells')} ('dim')")
        return int(shown.first()["value"])

    def pivots(self) -> tuple[list[int], np.ndarray]:
        """Numbers and pivots of the cells in force, by number."""
        made = self.spark.table(self.name("cells"))
        given_up = made.filter("given_up").select("cell")
        live = made.filter("NOT given_up").join(given_up, "cell", "left_anti").orderBy("cell").toArrow()
        return live.column("cell").to_pylist(), V._matrix(live.column("pivot"), self.dim())

    def cells(self) -> DataFrame:
        """(cell, n, r_min, r_max) of each cell in force that has rows."""
        live, _ = self.pivots()
        sizes = self.spark.table(self.name("sizes")).filter(F.col("cell").isin(live))
        return sizes.groupBy("cell").agg(
            F.sum("n").alias("n"), F.min("r_min").alias("r_min"), F.max("r_max").alias("r_max")
        )

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name("cells"))

    def drop(self) -> None:
        for part in ("cells", "sizes", "rows"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(part)}")

    def create(
        self, df: DataFrame, dim: int, id: str = "id", vec: str = "embedding", cells: int | None = None
    ) -> VectorIndex:
        """Chooses pivots among the rows, then loads them; an index of this name is dropped first.

        Pivots are the vectors with the smallest md5 of their id, about one for each 100,000 rows
        unless ``cells`` says how many. Rows without a vector take no part; ids are integers or
        text, and may repeat. An empty table gives an index that finds nothing until it is made anew.
        """
        self.drop()
        rows = V._ids_and_vectors(df, id, vec, "id")
        wanted = cells or max(1, -(-rows.count() // ROWS_A_CELL))
        self._check(wanted, dim)
        picked = rows.filter("vec is not null").orderBy(F.md5(F.col("id").cast("string").cast("binary")), "id")
        kind = rows.schema["id"].dataType.simpleString()
        self.spark.sql(
            f"CREATE TABLE {self.name('cells')} (cell bigint, pivot array<float>, given_up boolean) USING parquet "
            f"TBLPROPERTIES ('dim' = '{int(dim)}')"
        )
        self.spark.sql(
            f"CREATE TABLE {self.name('sizes')} (cell bigint, n bigint, r_min double, r_max double) USING parquet"
        )
        self.spark.sql(
            f"CREATE TABLE {self.name('rows')} (id {kind}, vec array<float>, r double, cell bigint) USING parquet "
            "PARTITIONED BY (cell)"
        )
        pivots = [r["vec"] for r in picked.limit(wanted).select("vec").collect()]
        self._commit(pivots, [], 0)
        self._load(rows, list(range(len(pivots))), V._matrix(self._pivot_column(0), dim))
        return self

    def append(self, df: DataFrame, id: str = "id", vec: str = "embedding") -> None:
        """Adds rows to the cells of their nearest pivots; what is there already is not read."""
        live, pivots = self.pivots()
        self._load(V._ids_and_vectors(df, id, vec, "id"), live, pivots)

    def split(self, most: int = 10 * ROWS_A_CELL) -> int:
        """Divides every cell of more than ``most`` rows, and says how many there were.

        Only the rows of those cells are read. They are written to new cells first; one write to
        ``_cells`` then brings the new ones into force and gives the old ones up; their files go
        last. A crash before that write leaves the old cells in force, one after it unread files.
        Copies of one vector cannot be divided: they stay in one cell, which a search cuts into blocks.
        """
        large = {r["cell"]: r["n"] for r in self.cells().filter(F.col("n") > most).collect()}
        if not large:
            return 0
        live, _ = self.pivots()
        read = self.rows().filter(F.col("cell").isin(list(large)))
        number = F.create_map(*[F.lit(x) for c, n in large.items() for x in (c, -(-2 * n // most))])
        hashed = F.md5(F.col("id").cast("string").cast("binary"))
        # some pivots of each cell: as many rows of it at most leave each task
        parts = max(-(-2 * n // most) for n in large.values())
        picked = V.top_k(read.select("cell", "id", "vec"), ["cell"], [hashed, F.col("id")], parts)
        chosen = picked.filter(F.col("rank") <= number[F.col("cell")]).orderBy("cell", "rank").select("vec").collect()
        self._check(len(live) - len(large) + len(chosen), self.dim())
        # a number never used, not even by a split that did not come to its end
        used = self.spark.table(self.name("cells")).select("cell").union(self.spark.table(self.name("sizes")).select("cell"))
        first = used.agg(F.max("cell")).first()[0] + 1
        new = self.spark.createDataFrame([(r["vec"],) for r in chosen], "pivot array<float>").toArrow()
        self._load(read.select("id", "vec"), list(range(first, first + len(chosen))), V._matrix(new.column("pivot"), self.dim()))
        self._commit([r["vec"] for r in chosen], list(large), first)
        self._remove(list(large))
        return len(large)

    def search(
        self,
        queries: DataFrame,
        k: int,
        probes: int | None = None,
        qid: str = "qid",
        qvec: str = "embedding",
    ) -> DataFrame:
        """(qid, id, similarity, rank): the ``k`` nearest of each query, ties by id.

        With ``probes`` a query reads that many nearest cells, and more only if they hold fewer than
        ``k`` rows; without, it reads its nearest cell and then those that may hold a nearer vector,
        which is exact. Partitions of other cells are not read.
        """
        stored = _Stored(self)
        if probes is None:
            return V.knn(queries, stored, k, stored.dim, qid, qvec, broadcast_bytes=0)
        return V.knn_approx(queries, stored, k, stored.dim, probes, qid, qvec)

    # --- writing ------------------------------------------------------------------------------

    def _check(self, cells: int, dim: int) -> None:
        if cells * dim * 8 > V.PIVOT_BYTES:
            raise ValueError(f"{cells} cells of {dim} dimensions are more than {V.PIVOT_BYTES} bytes of pivots")

    def _pivot_column(self, first: int):
        made = self.spark.table(self.name("cells")).filter((F.col("cell") >= first) & ~F.col("given_up"))
        return made.orderBy("cell").toArrow().column("pivot")

    def _commit(self, pivots: list, given_up: list[int], first: int) -> None:
        """One file with the new cells and those given up."""
        rows = [(first + i, p, False) for i, p in enumerate(pivots)] + [(c, None, True) for c in given_up]
        made = self.spark.createDataFrame(rows, "cell bigint, pivot array<float>, given_up boolean")
        made.coalesce(1).write.mode("append").insertInto(self.name("cells"))

    def _load(self, rows: DataFrame, cells: list[int], pivots: np.ndarray) -> None:
        """Sizes before rows: after a crash between them a search looks in too many cells, never in too few."""
        if not cells:
            return
        kind = rows.schema["id"].dataType.simpleString()
        assigned = rows.mapInArrow(
            V._nearest_pivot(pivots, self.dim()), f"id {kind}, vec array<float>, cell int, r double"
        )
        places = self.spark.createDataFrame(list(enumerate(cells)), "place int, number bigint")
        placed = materialize(
            assigned.withColumnRenamed("cell", "place")
            .join(F.broadcast(places), "place")
            .select("id", "vec", "r", F.col("number").alias("cell")),
            "assigned",
        )
        sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("r").alias("r_min"), F.max("r").alias("r_max"))
        sizes.coalesce(1).write.mode("append").insertInto(self.name("sizes"))
        # files by cell; a cell with much of the rows is cut at run time
        placed.hint("rebalance", "cell").write.mode("append").insertInto(self.name("rows"))

    def _remove(self, cells: list[int]) -> None:
        """Deletes the files of cells that are no longer in force."""
        shown = self.spark.sql(f"DESCRIBE FORMATTED {self.name('rows')}").filter("col_name = 'Location'")
        root = shown.first()["data_type"]
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for cell in cells:
            path = jvm.org.apache.hadoop.fs.Path(f"{root}/cell={cell}")
            path.getFileSystem(conf).delete(path, True)
        self.spark.catalog.refreshTable(self.name("rows"))
