"""A document store as a Spark data source, for tests of the connector path.

Documents are JSON lines in the files of a folder (option ``uri`` and
``collection``); a reader partition is a file, a writer task adds one, and the
files of a write show only after its commit. Options other than these are
refused, so that a test sees which ones arrive.
"""

import glob
import json
import os
import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "Server_Name string, Processor string, HR_Time string, `AVG_%_Processor_Time` string"


class StoreDouble(DataSource):
    @classmethod
    def name(cls):
        return "store_double"

    def schema(self):
        return self.options.get("schema", SCHEMA)

    def _folder(self):
        unknown = set(self.options) - {"uri", "collection", "schema", "fail"}
        if unknown:
            raise ValueError(f"unknown options {sorted(unknown)}")
        return os.path.join(self.options["uri"], self.options["collection"])

    def reader(self, schema):
        return StoreReader(self._folder(), schema)

    def writer(self, schema, overwrite):
        return StoreWriter(self._folder(), [f.name for f in schema.fields], overwrite, self.options.get("fail") == "true")


class StoreReader(DataSourceReader):
    def __init__(self, folder, schema):
        self.folder, self.names = folder, [f.name for f in schema.fields]

    def partitions(self):
        return [InputPartition(f) for f in sorted(glob.glob(os.path.join(self.folder, "*.jsonl")))] or [InputPartition(None)]

    def read(self, partition):
        if partition.value is None:
            return
        with open(partition.value) as f:
            for line in f:
                doc = json.loads(line)
                yield tuple(doc.get(n) for n in self.names)


class Written(WriterCommitMessage):
    def __init__(self, path):
        self.path = path


class StoreWriter(DataSourceWriter):
    def __init__(self, folder, names, overwrite, fail):
        self.folder, self.names, self.overwrite, self.fail = folder, names, overwrite, fail

    def write(self, rows):
        os.makedirs(self.folder, exist_ok=True)
        path = os.path.join(self.folder, f"{uuid.uuid4().hex}.part")
        with open(path, "w") as f:
            for row in rows:
                f.write(json.dumps(dict(zip(self.names, row)), default=str) + "\n")
        if self.fail:
            raise RuntimeError("the store is gone")
        return Written(path)

    def commit(self, messages):
        old = glob.glob(os.path.join(self.folder, "*.jsonl")) if self.overwrite else []
        for m in messages:
            os.rename(m.path, m.path.removesuffix(".part") + ".jsonl")
        for path in old:
            os.remove(path)

    def abort(self, messages):
        for path in glob.glob(os.path.join(self.folder, "*.part")):
            os.remove(path)
