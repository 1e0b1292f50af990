"""Tables that change together.

A store is a folder with data folders, each written once, and numbered
manifests that list the data folders of every table.  A commit stages all its
frames first and then swaps one manifest in by a rename that fails if the number
is taken.  Readers see the tables of one manifest; a run that fails before the
swap leaves nothing that is read, and can be repeated; a run that loses the race
for a number is told so.

A table may be clustered into folders by the hash of a key: ``probe`` then reads
the folders of given rows only."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

#: Folders of a clustered table; a parameter of each store, kept in its manifests.
BUCKETS = 64
BUCKET = "bucket"


class Conflict(RuntimeError):
    """Another run has committed since this one began."""


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.manifest = self._latest()
        self.buckets = self.manifest.setdefault("buckets", buckets)

    # --- reading ---------------------------------------------------------------

    @property
    def version(self) -> int:
        return self.manifest["version"]

    def read(self, table: str, schema: StructType) -> DataFrame:
        """The rows of a table; none where it was never written."""
        folders = self.manifest["tables"].get(table, [])
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/data/{table}")
        return reader.parquet(*[f"{self.root}/{f}" for f in folders]).select(*schema.names)

    def probe(self, table: str, schema: StructType, rows: DataFrame, key: str) -> DataFrame:
        """The rows of a clustered table that lie in the folders of the keys of
        ``rows``; at most one small number for each folder reaches the driver."""
        touched = [r[BUCKET] for r in rows.select(bucket_of(F.col(key), self.buckets).alias(BUCKET)).distinct().collect()]
        clustered = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
        return self.read(table, clustered).where(F.col(BUCKET).isin(sorted(touched))).drop(BUCKET)

    # --- writing ---------------------------------------------------------------

    def commit(self, append: dict[str, DataFrame] | None = None, replace: dict[str, DataFrame] | None = None,
               cluster: dict[str, str] | None = None, mark: dict | None = None) -> int:
        """Writes the frames and makes them visible at once.  ``cluster`` names the
        key of tables to be clustered; ``mark`` is kept in the manifest (such as
        the last batch of a stream).  Returns the new version."""
        tables = {k: list(v) for k, v in self.manifest["tables"].items()}
        for frames, keep in ((append or {}, True), (replace or {}, False)):
            for table, df in frames.items():
                folder = f"data/{table}/batch={uuid.uuid4().hex}"
                self._stage(df, f"{self.root}/{folder}", (cluster or {}).get(table))
                tables[table] = (tables.get(table, []) if keep else []) + [folder]
        new = {"version": self.version + 1, "buckets": self.buckets, "tables": tables,
               "marks": self.manifest.get("marks", {}) | (mark or {})}
        self._swap(new)
        self.manifest = new
        return new["version"]

    def _stage(self, df: DataFrame, path: str, key: str | None) -> None:
        if key is None:
            df.write.parquet(path)
            return
        # ranges of (folder, key): a folder is spread over tasks and files are sorted by the key
        (df.withColumn(BUCKET, bucket_of(F.col(key), self.buckets)).repartitionByRange(BUCKET, key)
           .sortWithinPartitions(BUCKET, key).write.partitionBy(BUCKET).parquet(path))

    # --- manifests ---------------------------------------------------------------

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _latest(self) -> dict:
        folder = self._path("manifests")
        fs = folder.getFileSystem(self._conf)
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        names = [n for n in names if n.startswith("v") and n.endswith(".json")]
        if not names:
            return {"version": 0, "tables": {}, "marks": {}}
        stream = fs.open(self._path(f"manifests/{max(names)}"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _swap(self, manifest: dict) -> None:
        staged = self._path(f"manifests/.staged-{uuid.uuid4().hex}")
        fs = staged.getFileSystem(self._conf)
        out = fs.create(staged, False)
        try:
            out.write(json.dumps(manifest).encode())
        finally:
            out.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri(), self._conf)
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            files.rename(fs.makeQualified(staged), fs.makeQualified(self._path(f"manifests/v{manifest['version']:012d}.json")), options)
        except Py4JJavaError as e:
            fs.delete(staged, False)
            if "FileAlreadyExists" in str(e.java_exception):
                raise Conflict(f"version {manifest['version']} of {self.root} exists") from e
            raise
