"""The cohort dataset: event tables, gene maps, sample meta and gene annotation.

All members are lazy DataFrames and every operation returns a new dataset.  One object serves one
sample or a whole cohort: rows carry the sample ``id``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.schema import EVENT_TABLES, GENE_TABLES, KEYS, conform, empty, map_schema, table_schema


@dataclass(frozen=True)
class CohortDataset:
    tables: Mapping[str, DataFrame]
    maps: Mapping[str, DataFrame]
    meta: DataFrame
    anno: DataFrame | None = None
    qc: DataFrame | None = None
    version: str = "v3"
    extra: Mapping[str, DataFrame] = field(default_factory=dict)

    # ------------------------------------------------------------------ building

    @classmethod
    def build(
        cls, spark: SparkSession, tables: Mapping[str, DataFrame | None], maps: Mapping[str, DataFrame | None],
        meta: DataFrame, anno: DataFrame | None = None, qc: DataFrame | None = None, version: str = "v3",
    ) -> "CohortDataset":
        """Conform everything to the versioned schema; absent members become empty tables."""
        def pick(given, schema):
            return empty(spark, schema) if given is None else conform(given, schema)

        return cls(
            tables={n: pick(tables.get(n), table_schema(n, version)) for n in (*EVENT_TABLES, *GENE_TABLES)},
            maps={n: pick(maps.get(n), map_schema(n)) for n in EVENT_TABLES},
            meta=conform(meta, table_schema("meta", version)),
            anno=None if anno is None else conform(anno, table_schema("anno", version)),
            qc=qc, version=version,
        )

    def with_version(self, version: str) -> "CohortDataset":
        """Move between schema versions; added columns are NULL, removed ones are dropped."""
        tables = {n: conform(t, table_schema(n, version)) for n, t in self.tables.items()}
        return replace(self, tables=tables, version=version)

    # ------------------------------------------------------------------ accessors

    def table(self, name: str) -> DataFrame:
        return self.tables[name]

    def map(self, name: str) -> DataFrame:
        return self.maps[name]

    def with_table(self, name: str, df: DataFrame) -> "CohortDataset":
        return replace(self, tables={**self.tables, name: df})

    def with_map(self, name: str, df: DataFrame) -> "CohortDataset":
        return replace(self, maps={**self.maps, name: df})

    def with_meta_field(self, name: str, value) -> "CohortDataset":
        col = value if not isinstance(value, (str, int, float, bool, type(None))) else F.lit(value)
        return replace(self, meta=self.meta.withColumn(name, col))

    def ids(self) -> DataFrame:
        return self.meta.select("id")

    # ------------------------------------------------------------------ subsets

    def subset(self, column: str, values: Iterable | DataFrame) -> "CohortDataset":
        """Rows whose ``column`` is among ``values``; members without that column stay as they are.

        A list becomes a pushed-down filter, a one-column DataFrame a semi join.
        """
        if isinstance(values, DataFrame):
            wanted = values.select(F.col(values.columns[0]).alias(column))
            cut = lambda df: df.join(wanted, column, "left_semi") if column in df.columns else df
        else:
            listed = list(values)
            cut = lambda df: df.filter(F.col(column).isin(listed)) if column in df.columns else df
        return replace(
            self,
            tables={n: cut(t) for n, t in self.tables.items()},
            maps={n: cut(m) for n, m in self.maps.items()},
            meta=cut(self.meta),
        )

    def subset_ids(self, ids: Iterable | DataFrame) -> "CohortDataset":
        return self.subset("id", ids)

    def subset_rows(self, numbers: Iterable[int]) -> "CohortDataset":
        """Samples by 1-based place in the id order of ``meta``."""
        from pyspark.sql import Window

        wanted = sorted(set(numbers))
        # A top-n of the largest number asked for comes first, so only that many ids are ever in one task.
        first = self.meta.select("id").orderBy("id").limit(wanted[-1] if wanted else 0)
        chosen = first.withColumn("__rn", F.row_number().over(Window.orderBy("id"))).filter(F.col("__rn").isin(wanted))
        return self.subset("id", chosen.select("id"))

    def subset_genes(self, names: Iterable[str] = (), gene_ids: Iterable[str] = ()) -> "CohortDataset":
        """Events touching the genes (through the maps) and the gene tables; ``meta`` is kept."""
        names, gene_ids = list(names), list(gene_ids)
        cond = F.col("gene_id").isin(gene_ids)
        if names:
            known = self.anno.filter(F.col("gene_name").isin(names)).select("gene_id")
            if gene_ids:
                known = known.unionByName(self.anno.filter(cond).select("gene_id"))
            genes = known.distinct()
            cut = lambda df: df.join(genes, "gene_id", "left_semi")
        else:
            cut = lambda df: df.filter(cond)
        maps = {n: cut(m) for n, m in self.maps.items()}
        tables = dict(self.tables)
        for n, m in maps.items():
            tables[n] = tables[n].join(m, ["id", "var_id"], "left_semi")
        for n in GENE_TABLES:
            tables[n] = cut(tables[n])
        return replace(self, tables=tables, maps=maps)

    def keep_tables(self, names: Iterable[str]) -> "CohortDataset":
        """Empty every table (and its map) that is not listed; the schema stays."""
        names = set(names)
        none = lambda df: df.filter(F.lit(False))
        return replace(
            self,
            tables={n: t if n in names else none(t) for n, t in self.tables.items()},
            maps={n: m if n in names else none(m) for n, m in self.maps.items()},
        )

    # ------------------------------------------------------------------ stacking, checking, applying

    @staticmethod
    def stack(parts: Iterable["CohortDataset"], anno: DataFrame | None = None) -> "CohortDataset":
        """Union of datasets of one version; columns a part lacks are NULL."""
        parts = list(parts)
        if len({p.version for p in parts}) != 1:
            raise ValueError("datasets of different versions cannot be stacked")
        both = lambda dfs: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
        first = parts[0]
        qcs = [p.qc for p in parts if p.qc is not None]
        return replace(
            first,
            tables={n: both([p.tables[n] for p in parts]) for n in first.tables},
            maps={n: both([p.maps[n] for p in parts]) for n in first.maps},
            meta=both([p.meta for p in parts]),
            anno=anno if anno is not None else first.anno,
            qc=both(qcs) if qcs else None,
        )

    def check_version(self, allowed: Iterable[str]) -> None:
        if self.version not in set(allowed):
            raise ValueError(f"unsupported version {self.version}, valid: {', '.join(allowed)}")

    def check_samples(self, expect: int = 1) -> None:
        """Stops counting one past the expected number."""
        found = self.meta.limit(expect + 1).count()
        if found != expect:
            raise ValueError(f"dataset holds {'more' if found > expect else found} samples, expected {expect}")

    def apply_per_sample(self, table: str, fun: Callable, schema: str) -> DataFrame:
        """Run a pandas function on each sample's rows of one table (user extension point).

        One sample is one Arrow group, so this is for tables whose rows per sample are bounded.
        """
        return self.tables[table].groupBy("id").applyInPandas(fun, schema)

    def to_local(self, table: str):
        """Hand a table to the caller as pandas; never used inside the library."""
        return self.tables[table].toPandas()

    # ------------------------------------------------------------------ storage

    def members(self) -> dict[str, DataFrame]:
        out = {f"tables_{n}": t for n, t in self.tables.items()}
        out.update({f"maps_{n}": m for n, m in self.maps.items()})
        out["meta"] = self.meta
        if self.anno is not None:
            out["anno"] = self.anno
        if self.qc is not None:
            out["qc"] = self.qc
        return out

    def save(self, path: str, mode: str = "errorifexists", sample_buckets: int = 0) -> None:
        """Write every member as parquet, sorted by its key inside files.

        Sorting gives the parquet min/max statistics that let a later filter on ``id`` skip files and
        row groups.  Rows are spread over (id, var_id), not by id alone, so one large sample does
        not become one task; ``sample_buckets`` adds an id-hash directory level for pruning.
        """
        for name, df in self.members().items():
            base = name.removeprefix("tables_").removeprefix("maps_")
            keys = [k for k in KEYS.get(base, []) if k in df.columns]
            out = df
            if keys:
                out = out.repartition(*keys).sortWithinPartitions(*keys)
            if sample_buckets and name.startswith(("tables_", "maps_")):
                out = out.withColumn("id_bucket", F.pmod(F.xxhash64("id"), F.lit(sample_buckets)).cast("int"))
                out.write.mode(mode).partitionBy("id_bucket").parquet(f"{path}/{name}")
            else:
                out.write.mode(mode).parquet(f"{path}/{name}")

    @classmethod
    def open(cls, spark: SparkSession, path: str, version: str = "v3") -> "CohortDataset":
        """Open a stored dataset lazily; members that were never written are empty."""
        from pyspark.errors import AnalysisException

        def read(name: str):
            try:
                df = spark.read.parquet(f"{path}/{name}")
            except AnalysisException as err:
                if "PATH_NOT_FOUND" in str(err) or "UNABLE_TO_INFER_SCHEMA" in str(err):
                    return None
                raise
            return df.drop("id_bucket")

        meta = read("meta")
        if meta is None:
            raise FileNotFoundError(f"no dataset at {path}")
        return cls.build(
            spark, {n: read(f"tables_{n}") for n in (*EVENT_TABLES, *GENE_TABLES)},
            {n: read(f"maps_{n}") for n in EVENT_TABLES}, meta, read("anno"), read("qc"), version,
        )
