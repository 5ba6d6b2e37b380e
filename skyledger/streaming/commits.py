"""The commit log of a results folder: what counts of it, and since when.

Data is written to folders of its own, named after the attempt. Nobody reads them until a commit
file says so, which is created once and whole. A reader lists commits only, so it sees a batch
as a whole or not at all, whatever attempts are running, were killed or lost a race.

Every ``_EVERY`` commits one more file lists all entries so far: a reader opens that and the few
commits behind it, however long the history.
"""

import json

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from skyledger.streaming.files import create_once, file_names, read_text

_EVERY = 64


class Commits:
    """The log under ``path``. Entries are small dictionaries by batch number."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.log = spark, path, f"{path}/_log"

    def claim(self, owner: str) -> None:
        """Mark the folder as the owner's; stop if it is another one's."""
        mark = f"{self.log}/owner"
        if read_text(self.spark, mark) != owner and not create_once(self.spark, mark, owner):
            if read_text(self.spark, mark) != owner:
                raise ValueError(f"{self.path} holds the results of another query; use a new folder")

    def keep_schema(self, schema: StructType) -> None:
        """Keep the schema of the folder's rows; stop if an earlier one differs in names or types."""
        kept = self.schema()
        if kept is None and not create_once(self.spark, f"{self.log}/schema", schema.json()):
            kept = self.schema()
        if kept is not None and [(f.name, f.dataType) for f in kept] != [(f.name, f.dataType) for f in schema]:
            raise ValueError(f"{self.path} holds {kept.simpleString()}, not {schema.simpleString()}")

    def schema(self) -> StructType | None:
        text = read_text(self.spark, f"{self.log}/schema")
        if text is None:
            return None
        schema = StructType.fromJson(json.loads(text))
        for field in schema:
            field.nullable = True
        return schema

    def publish(self, batch_id: int, entry: dict) -> bool:
        """Commit a batch; False if it has been committed before."""
        if not create_once(self.spark, f"{self.log}/{batch_id:020d}.json", json.dumps(entry)):
            return False
        if batch_id % _EVERY == _EVERY - 1:
            create_once(self.spark, f"{self.log}/{batch_id:020d}.all", json.dumps(self.entries()))
        return True

    def ids(self) -> list[int]:
        """The numbers of all committed batches, in order; no file is opened."""
        return sorted(int(n[:-5]) for n in file_names(self.spark, self.log) if n.endswith(".json"))

    def entry(self, batch_id: int) -> dict | None:
        text = read_text(self.spark, f"{self.log}/{batch_id:020d}.json")
        return None if text is None else json.loads(text)

    def entries(self, since: int | None = None, until: int | None = None) -> dict[int, dict]:
        """Committed batches by number, in order: those after ``since``, up to ``until``."""
        names = file_names(self.spark, self.log)
        listed = max((int(n[:-4]) for n in names if n.endswith(".all")), default=-1)
        found = {}
        if listed >= 0 and (since is None or since < listed):
            found = {int(k): v for k, v in json.loads(read_text(self.spark, f"{self.log}/{listed:020d}.all")).items()}
        wanted = [int(n[:-5]) for n in names if n.endswith(".json")]
        for batch_id in wanted:
            if batch_id not in found and (since is None or batch_id > since) and (until is None or batch_id <= until):
                found[batch_id] = self.entry(batch_id)
        return {k: found[k] for k in sorted(found) if (since is None or k > since) and (until is None or k <= until)}
