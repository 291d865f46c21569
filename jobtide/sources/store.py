"""Where the layers live: three databases, or three folders of Parquet below a shared root."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.sources import profiles

_INPUTS = (
    "job_postings", "benefits", "employee_counts", "job_skills",
    "companies", "job_industries", "company_industries", "company_specialities",
)
TABLES = {
    "bronze": _INPUTS,
    "silver": _INPUTS,
    "gold": (
        "job_postings", "job_industries", "job_skills", "company_profile", "job_analytics",
    ),
}
LAYERS = tuple(TABLES)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the session's shared checkpoint folder.

    That is ``spark.checkpoint.dir``, or the folder given to ``setCheckpointDir``. Only a session
    on one machine may do without: it gets a temporary folder. Elsewhere a missing setting is an
    error, since a machine-local folder would be another one on every executor.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="jobtide-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


BATCH = "load_batch"
MANIFEST = "jobtide.manifest"
KEPT_MANIFESTS = 10


def files(spark: SparkSession, path: str):
    """(file system, path) of the session's Hadoop configuration."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


class TableStore:
    """Writes and reads the tables of the three layers.

    ``namespace`` prefixes the databases (``jobs_bronze``, ``jobs_silver``, ``jobs_gold``);
    with ``root`` the tables are Parquet folders below ``root/<layer>/<table>`` instead.

    A rebuilt table is a new version, beside the old one. Which versions make up a layer is told by
    its manifest, one small value that is replaced in one step, so a layer changes as a whole or not
    at all: see ``building``. The version before stays for those who read it. In databases a table's
    name is a view of its version. Bronze tables are partitioned by load: files that arrive later are
    appended to what is there, whoever wrote it. One writer at a time may publish a layer.
    """

    def __init__(self, spark: SparkSession, namespace: str = "jobs", root: str | None = None):
        self.spark = spark
        self.namespace = namespace
        self.root = root and root.rstrip("/")
        self._current: str | None = None
        self._views: dict[str, str] = {}
        self._staged: dict[str, dict[str, str]] = {}

    def create_namespaces(self) -> None:
        """Create the databases that do not exist yet."""
        if self.root is None:
            for layer in LAYERS:
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.namespace}_{layer}")

    def name(self, layer: str, table: str) -> str:
        """Qualified table name, or folder."""
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        if self.root is None:
            return f"{self.namespace}_{layer}.{table}"
        return f"{self.root}/{layer}/{table}"

    # --- manifests ---

    def _catalog(self):
        return self.spark._jsparkSession.sessionState().catalog()

    def _manifests(self, layer: str) -> list[str]:
        fs, path = files(self.spark, f"{self.root}/{layer}/_manifest")
        if not fs.exists(path):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(path)]
        return sorted(n for n in names if re.fullmatch(r"\d{8}\.json", n))

    def manifest(self, layer: str) -> dict[str, dict[str, str]]:
        """The layer as it is now: ``tables`` maps names to versions, ``before`` to those replaced."""
        text = None
        if self.root is None:
            catalog, database = self._catalog(), f"{self.namespace}_{layer}"
            if catalog.databaseExists(database):
                found = catalog.getDatabaseMetadata(database).properties().get(MANIFEST)
                text = found.get() if found.isDefined() else None
        elif names := self._manifests(layer):
            fs, path = files(self.spark, f"{self.root}/{layer}/_manifest/{names[-1]}")
            stream = fs.open(path)
            try:
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
        return json.loads(text) if text else {"tables": {}, "before": {}}

    def _write_manifest(self, layer: str, manifest: dict) -> None:
        text = json.dumps(manifest, separators=(",", ":"))
        if self.root is None:
            self.spark.sql(
                f"ALTER DATABASE {self.namespace}_{layer} SET DBPROPERTIES ('{MANIFEST}' = '{text}')"
            )
            return
        names = self._manifests(layer)
        folder = f"{self.root}/{layer}/_manifest"
        fs, new = files(self.spark, f"{folder}/{int(names[-1][:8]) + 1 if names else 1:08d}.json")
        part = files(self.spark, f"{folder}/.{uuid.uuid4().hex}")[1]
        out = fs.create(part)
        out.writeBytes(text)
        out.close()
        if fs.exists(new) or not fs.rename(part, new):
            fs.delete(part, False)
            raise RuntimeError(f"layer {layer} was published by somebody else meanwhile")
        for old in names[: 1 - KEPT_MANIFESTS]:
            fs.delete(files(self.spark, f"{folder}/{old}")[1], False)

    def publish(self, layer: str, versions: dict[str, str]) -> None:
        """Make complete ``versions`` the tables of the layer, all in one step.

        The versions they replace stay until they are replaced once more.
        """
        now = self.manifest(layer)
        versions = {t: v for t, v in versions.items() if now["tables"].get(t) != v}
        adopted = {}
        if self.root is None:
            for table in versions:
                name = self.name(layer, table)
                if table not in now["tables"] and self._is_table(name):  # made by somebody else
                    adopted[table] = uuid.uuid4().hex
                    self.spark.sql(f"ALTER TABLE {name} RENAME TO {self.place(layer, table, adopted[table])}")
        replaced = {t: v for t, v in {**now["tables"], **adopted}.items() if t in versions}
        self._write_manifest(
            layer,
            {"tables": now["tables"] | versions, "before": now["before"] | replaced},
        )
        self._point(layer)
        for table in versions:
            if table in now["before"]:
                self._drop(layer, table, now["before"][table])

    @contextmanager
    def building(self, layer: str):
        """Tables rebuilt inside become the layer's together at the end, or not at all.

        Meanwhile everybody, this store too, reads the layer as it was; ``rebuild`` returns the new
        table. If the build fails, its versions go.
        """
        if layer in self._staged:
            raise ValueError(f"layer {layer} is being built already")
        staged = self._staged[layer] = {}
        try:
            yield
            self.publish(layer, staged)
        except BaseException:
            current = self.manifest(layer)["tables"]
            for table, version in staged.items():
                if current.get(table) != version:
                    self._drop(layer, table, version)
            raise
        finally:
            del self._staged[layer]

    def clean(self, layer: str) -> list[str]:
        """Remove versions that builds which were killed have left, and return their places."""
        now = self.manifest(layer)
        gone = []
        for table in TABLES[layer]:
            kept = {now["tables"].get(table), now["before"].get(table), self._staged.get(layer, {}).get(table)}
            for version in self._all(layer, table):
                if version not in kept:
                    self._drop(layer, table, version)
                    gone.append(self.place(layer, table, version))
        return gone

    def _drop(self, layer: str, table: str, version: str) -> None:
        place = self.place(layer, table, version)
        if self.root is None:
            self.spark.sql(f"DROP TABLE IF EXISTS {place}")
            return
        fs, path = files(self.spark, place)
        fs.delete(path, True)

    def _all(self, layer: str, table: str) -> list[str]:
        """All versions there are, finished or not."""
        name = self.name(layer, table)
        if self.root is None:
            if not self._catalog().databaseExists(f"{self.namespace}_{layer}"):
                return []
            found = self.spark.catalog.listTables(f"{self.namespace}_{layer}", f"{table}__*")
            return sorted(t.name.removeprefix(f"{table}__") for t in found)
        fs, path = files(self.spark, name)
        if not fs.exists(path):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(path)]
        return sorted(n for n in names if re.fullmatch(r"v\d{8}-\w+", n))

    def _is_table(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name) and self.spark.catalog.getTable(name).tableType != "VIEW"

    def _point(self, layer: str) -> None:
        """Names follow the manifest: views in databases, temporary ones if the layer is in use."""
        versions = self.manifest(layer)["tables"]
        if self.root is not None:
            if self._current == layer and versions != self._views:
                for view in self._views.keys() - versions.keys():
                    self.spark.catalog.dropTempView(view)
                for table, version in versions.items():
                    if self._views.get(table) != version:
                        self._read(layer, table, version).createOrReplaceTempView(table)
                self._views = versions
            return
        for table, version in versions.items():
            name, place = self.name(layer, table), self.place(layer, table, version)
            if not self._shows(name, place):
                self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {place}")

    def _shows(self, name: str, place: str) -> bool:
        if not self.spark.catalog.tableExists(name):
            return False
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
        return any(r["col_name"] == "View Text" and r["data_type"].endswith(place) for r in rows)

    # --- versions ---

    def _version(self, layer: str, table: str) -> str | None:
        """The current version; an empty text for a table of a database made by somebody else."""
        found = self.manifest(layer)["tables"].get(table)
        if found is None and self.root is None and self._is_table(self.name(layer, table)):
            return ""
        return found

    def exists(self, layer: str, table: str) -> bool:
        return self._version(layer, table) is not None

    def generation(self, layer: str, table: str) -> str | None:
        """Which full load the table stems from; None if there is no table."""
        version = self._version(layer, table)
        return "first" if version == "" else version

    def begin(self, layer: str, table: str) -> str:
        """Name of a new version, empty and not yet in use; ``finish`` puts it in its place."""
        mark = uuid.uuid4().hex
        if self.root is None:
            return mark
        made = [int(v[1:9]) for v in self._all(layer, table)]
        return f"v{max(made, default=0) + 1:08d}-{mark}"

    def place(self, layer: str, table: str, version: str) -> str:
        """Folder, or table, that holds a version."""
        name = self.name(layer, table)
        if self.root is not None:
            return f"{name}/{version}"
        return f"{name}__{version}" if version else name

    def finish(self, layer: str, table: str, version: str) -> None:
        """Make a complete version the table, at the end of the ``building`` it is made in if any."""
        if layer in self._staged:
            self._staged[layer][table] = version
        else:
            self.publish(layer, {table: version})

    # --- whole tables ---

    def rebuild(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        bucket_by: str | None = None,
        buckets: int | None = None,
    ) -> DataFrame:
        """Replace a table by ``df`` and return the new table as stored.

        If ``df`` fails, the old table is as it was. With ``buckets`` a managed table is bucketed
        and sorted by ``bucket_by``; joins of two tables bucketed alike on their key then read
        without a shuffle. Folder tables cannot be bucketed and refuse.
        """
        if buckets and self.root is not None:
            raise ValueError("only tables in databases can be bucketed, not folders")
        if buckets and not bucket_by:
            raise ValueError("buckets need bucket_by")
        version = self.begin(layer, table)
        place = self.place(layer, table, version)
        if layer == "bronze":
            df = df.withColumn(BATCH, F.lit(-1).cast("bigint"))
        if buckets:
            df = df.repartition(buckets, bucket_by)
        writer = df.write.format("parquet")
        if layer == "bronze":
            writer = writer.partitionBy(BATCH)
        if buckets:
            writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
        try:
            writer.save(place) if self.root is not None else writer.saveAsTable(place)
        except BaseException:
            self._drop(layer, table, version)
            raise
        self.finish(layer, table, version)
        return self._read(layer, table, version)

    def append_batch(
        self, layer: str, table: str, df: DataFrame, batch: int, version: str | None = None
    ) -> None:
        """Add one load to the table, or to an unfinished ``version`` of it.

        A load replaces what it wrote itself before, so repeating it after a failure is safe.
        """
        version = self._version(layer, table) if version is None else version
        target = self.place(layer, table, version)
        df = df.withColumn(BATCH, F.lit(batch).cast("bigint"))
        if self.root is not None:
            df.drop(BATCH).write.mode("overwrite").parquet(f"{target}/{BATCH}={batch}")
            return
        if not self.spark.catalog.tableExists(target):
            df.write.format("parquet").partitionBy(BATCH).saveAsTable(target)
            return
        columns = ", ".join(f"`{c}`" for c in self.spark.table(target).columns if c != BATCH)
        session, view = df.sparkSession, f"load_{uuid.uuid4().hex}"
        df.createOrReplaceTempView(view)
        session.sql(
            f"INSERT OVERWRITE TABLE {target} PARTITION ({BATCH} = {batch}) "
            f"SELECT {columns} FROM {view}"
        )
        session.catalog.dropTempView(view)

    def _read(self, layer: str, table: str, version: str) -> DataFrame:
        place = self.place(layer, table, version)
        df = self.spark.table(place) if self.root is None else self.spark.read.parquet(place)
        return df.drop(BATCH) if layer == "bronze" else df

    def written_directly(self, table: str) -> DataFrame:
        """Rows of a bronze table that did not come from files."""
        place = self.place("bronze", table, self._version("bronze", table))
        df = self.spark.table(place) if self.root is None else self.spark.read.parquet(place)
        return df.where(F.col(BATCH) == -1).drop(BATCH) if BATCH in df.columns else df

    def read(self, layer: str, table: str) -> DataFrame:
        """The table as it is now."""
        version = self._version(layer, table)
        if version is None:
            raise ValueError(f"there is no table {self.name(layer, table)}")
        return self._read(layer, table, version)

    def read_layer(self, layer: str) -> dict[str, DataFrame]:
        """All tables of a layer, of one publication: none is older or newer than the others."""
        versions = self.manifest(layer)["tables"]
        return {table: self._read(layer, table, version) for table, version in versions.items()}

    def use(self, layer: str) -> None:
        """Make ``layer`` current, so that SQL text can name its tables without a prefix.

        Folder tables become temporary views, and those of the layer used before go. Names follow
        what this store publishes at once, and what others do with the next ``sql``.
        """
        if self.root is None:
            self._point(layer)
            self.spark.catalog.setCurrentDatabase(f"{self.namespace}_{layer}")
            return
        if self._current != layer:
            for view in self._views:
                self.spark.catalog.dropTempView(view)
            self._current, self._views = layer, {}
        self._point(layer)

    def sql(self, text: str) -> DataFrame:
        """The result of SQL text, whose unqualified names are the tables of the current layer as it
        was published last, by whomever."""
        if self._current is not None:
            self._point(self._current)
        return self.spark.sql(text)

    # --- content checks ---

    def profile(self, layer: str, table: str, before: bool = False) -> DataFrame:
        """What ``profiles.profile`` finds of the table, or of the version ``before`` it.

        Stored beside the version, which does not change, and read from there the next time; a
        bronze table grows with every load and is read anew.
        """
        manifest = self.manifest(layer)
        version = manifest["before"].get(table) if before else self._version(layer, table)
        if version is None:
            raise ValueError(f"there is no such version of {self.name(layer, table)}")
        df = self._read(layer, table, version)
        if layer == "bronze" or version == "":
            return profiles.profile(df)
        base = self.root or f"{self.spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{self.namespace}"
        path = f"{base}/{layer}/_profiles/{table}/{version}"
        fs, at = files(self.spark, f"{path}/_SUCCESS")
        if not fs.exists(at):
            profiles.profile(df).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def changes(self, layer: str, table: str) -> DataFrame:
        """How a table differs from its version before, column by column."""
        return profiles.compare(self.profile(layer, table, before=True), self.profile(layer, table))

    def preview(self, layer: str, table: str, n: int = 20) -> DataFrame:
        """A look at the content: ``n`` rows, whichever are found first."""
        return self.read(layer, table).limit(n)

    def row_counts(self, layer: str, tables: tuple[str, ...] | None = None) -> DataFrame:
        """Rows of every table of a layer, or of the given ones, counted in one job."""
        counts = [
            self.read(layer, table).agg(F.lit(table).alias("table"), F.count("*").alias("rows"))
            for table in tables or TABLES[layer]
        ]
        return reduce(DataFrame.unionByName, counts)


def fetch(df: DataFrame, max_rows: int = 10_000):
    """A finished report as a pandas frame; refuses results larger than ``max_rows``."""
    rows = df.limit(max_rows + 1).toPandas()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows: write the result to a table instead")
    return rows
