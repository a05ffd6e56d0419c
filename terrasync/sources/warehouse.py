"""Versioned tables under one folder, published together.

A plain table is a parquet folder that is never written twice. A keyed table is dealt into buckets by a hash
of its key, each a folder of its own, with layers of later changes over them: a change writes its own rows, and
marks of removed keys, as one more layer. A read takes a key's newest row; buckets that no layer touches are read as they are.
Once the layers have grown to a share of the table, the touched buckets are written anew, and one that holds too
many rows by then is split by further bits of the hash, on its own.
Which folders make up the warehouse is said by numbered manifests, of which the last holds. A job writes its new tables first and then publishes them all
by adding one manifest; a crash before leaves the old state, and readers never see half of a job. A job claims the
next manifest's number before it starts, and other jobs fail until it is through. sweep removes folders that no kept manifest names.
What a job is about to send to a database is noted before, and forgotten once the job is published, so that the next one can put right what a dead one has left there.
"""

from __future__ import annotations

import json
import re
import threading
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import normal

#: What the manifest says of a table: its folder, or of a keyed one its key, schema, number of buckets, their folders and
#: sizes (rows, bytes), and its layers (folder, number, rows by bucket, bytes). A bucket that was split has names of its own: residue-modulus.
Entry = str | dict
BUCKET, MOST_BUCKETS = "terrasync_bucket", 4096
#: Columns of a layer beside the table's: the key as normal text, whether the key is removed, the layer's number.
NID, GONE, LAYER = "terrasync_nid", "terrasync_gone", "terrasync_layer"


def _bucket(nid: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(nid, F.lit(""))), F.lit(buckets)).cast("int")


def _named(name: str, buckets: int) -> tuple[int, int]:
    """Residue and modulus of a bucket."""
    residue, _, modulus = name.partition("-")
    return int(residue), int(modulus or buckets)


def _name(residue: int, modulus: int, buckets: int) -> str:
    return str(residue) if modulus == buckets else f"{residue}-{modulus}"


class Busy(RuntimeError):
    """Another job holds the claim, or has taken it over."""


class Claim:
    """The right to publish one manifest: a file that names it, made by one job only, and gone when the with block ends.

    The holder touches the file as long as it lives. One that hasn't been touched for a lease is a dead job's, and the next claim takes its place.
    """

    def __init__(self, house: Warehouse, number: int):
        self.house, self.number, self.token = house, number, uuid.uuid4().hex
        self.path = f"claims/{number:012d}"
        self._over = threading.Event()
        self._beats = threading.Thread(target=self._beat, daemon=True)

    def __enter__(self) -> Claim:
        house = self.house
        for name, _, touched in house._children("claims"):
            if name == f"{self.number:012d}" and touched < (time.time() - house.lease) * 1000:
                # Moved away under a name of its own before it is deleted: of two jobs that find it, one can move it.
                fs, dead = house._place(self.path)
                _, away = house._place(f"drafts/{self.token}")
                fs.mkdirs(away.getParent())
                if fs.rename(dead, away):
                    fs.delete(away, False)
        try:
            house._create(self.path, self.token)
        except Py4JJavaError as e:
            if house._exists(self.path):
                raise Busy(f"another job has claimed manifest {self.number}") from e
            raise
        self.check()
        self._beats.start()
        return self

    def __exit__(self, *error) -> None:
        self._over.set()
        if self._beats.is_alive():
            self._beats.join()
        if self._mine():
            fs, place = self.house._place(self.path)
            fs.delete(place, False)

    def _beat(self) -> None:
        fs, place = self.house._place(self.path)
        while not self._over.wait(self.house.lease / 4):
            if not self._mine():
                return
            fs.setTimes(place, int(time.time() * 1000), -1)

    def _mine(self) -> bool:
        try:
            return self.house._text(self.path) == self.token
        except Py4JJavaError:
            return False

    def check(self) -> None:
        """Raises Busy where the claim has been taken over, or its manifest is there."""
        if not self._mine() or self.house._last()[0] + 1 != self.number:
            raise Busy(f"another job has taken over or published manifest {self.number}")


class Warehouse:
    """rows_per_bucket settles the buckets of a keyed table when it is first written (a power of two, MOST_BUCKETS at most), and those that are split.

    Layers are merged into the buckets once they hold that share of the table's bytes, or are that many. A claim that its job hasn't touched
    for a lease (seconds) is void.
    """

    def __init__(self, spark: SparkSession, root: str, rows_per_bucket: int = 1_000_000, share: float = 0.25, most_layers: int = 16, lease: float = 600.0):
        self.spark, self.root, self.rows_per_bucket, self.share, self.most_layers, self.lease = spark, root.rstrip("/"), rows_per_bucket, share, most_layers, lease

    def _place(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}")
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _bytes(self, path: str) -> int:
        fs, place = self._place(path)
        return fs.getContentSummary(place).getLength()

    def _children(self, path: str) -> list[tuple[str, bool, int]]:
        """Name, whether it is a folder, and time of change (ms) of what lies in a folder."""
        fs, folder = self._place(path)
        return [(s.getPath().getName(), s.isDirectory(), s.getModificationTime()) for s in fs.listStatus(folder)] if fs.exists(folder) else []

    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n, *_ in self._children("manifests") if n.removesuffix(".json").isdigit())

    def _exists(self, path: str) -> bool:
        fs, place = self._place(path)
        return fs.exists(place)

    def _text(self, path: str) -> str:
        fs, place = self._place(path)
        stream = fs.open(place)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _create(self, path: str, text: str) -> None:
        """Writes a new file; an error where there is one."""
        fs, place = self._place(path)
        fs.mkdirs(place.getParent())
        out = fs.create(place, False)
        out.write(bytearray(text.encode()))
        out.close()

    def _manifest(self, number: int) -> dict[str, Entry]:
        return json.loads(self._text(f"manifests/{number:012d}.json"))

    def _last(self) -> tuple[int, dict[str, Entry]]:
        numbers = self._numbers()
        return (numbers[-1], self._manifest(numbers[-1])) if numbers else (0, {})

    # ---- reads

    def exists(self, name: str) -> bool:
        return name in self._last()[1]

    def read(self, name: str) -> DataFrame | None:
        entry = self._last()[1].get(name)
        return self.staged(entry) if entry else None

    def read_holding(self, name: str, ids: DataFrame) -> DataFrame:
        """The part of a table that can hold keys among ids (nid, normal text): their buckets, or all of a plain table."""
        entry = self._last()[1][name]
        return self.staged(entry) if isinstance(entry, str) else self.staged(entry, self._touched(entry, ids))

    def staged(self, entry: Entry, residues: set[int] | None = None) -> DataFrame:
        """A version of a table; of a keyed one only the buckets of those residues (by the largest modulus), if given."""
        if isinstance(entry, str):
            return self.spark.read.parquet(f"{self.root}/{entry}")
        wanted = entry["parts"].keys() if residues is None else self._holders(entry, residues)
        layers = entry.get("layers") or []
        if not layers:
            return self._parts(entry, wanted)
        schema = T.StructType.fromJson(entry["schema"])
        over = None
        for x in layers:
            one = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(NID, T.StringType()), T.StructField(GONE, T.BooleanType())])).parquet(f"{self.root}/{x['path']}").withColumn(LAYER, F.lit(x["number"]))
            over = one if over is None else over.unionByName(one)
        modulus = self._modulus(entry)
        if residues is not None:
            over = over.where(_bucket(F.col(NID), modulus).isin(sorted(residues)))
        # Keys are unique in a layer, so the newest row of a key is found by partial aggregation; rows without a key stay each.
        row = F.struct(*schema.names, GONE)
        newest = over.where(F.col(NID).isNotNull()).groupBy(NID).agg(F.max_by(row, LAYER).alias("row"))
        live = newest.where(~F.col("row")[GONE]).select("row.*").drop(GONE).unionByName(over.where(F.col(NID).isNull()).select(*schema.names))
        touched = self._holders(entry, {int(r) for x in layers for r in x["rows"]})
        old = self._parts(entry, [p for p in wanted if p in touched])
        kept = old.withColumn(NID, normal(old, entry["key"])).join(newest.select(NID), NID, "left_anti").select(*schema.names)
        return self._parts(entry, [p for p in wanted if p not in touched]).unionByName(kept).unionByName(live)

    def _parts(self, entry: dict, names) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        paths = [f"{self.root}/{entry['parts'][p]}" for p in names if p in entry["parts"]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    @staticmethod
    def _modulus(entry: dict) -> int:
        return max([entry["buckets"], *(_named(p, entry["buckets"])[1] for p in entry["parts"])])

    def _holders(self, entry: dict, residues: set[int]) -> set[str]:
        """The buckets that can hold keys of those residues by the largest modulus: of each the finest one there is."""
        n, modulus = entry["buckets"], self._modulus(entry)
        out = set()
        for r in residues:
            m = modulus
            while m > n and _name(r % m, m, n) not in entry["parts"]:
                m //= 2
            out.add(_name(r % m, m, n))
        return out

    def _touched(self, entry: dict, ids: DataFrame) -> set[int]:
        """At most as many numbers as there are buckets."""
        return set(self._rows_by_residue(ids.select("nid"), self._modulus(entry)))

    @staticmethod
    def _rows_by_residue(ids: DataFrame, modulus: int) -> dict[int, int]:
        return {r[0]: r[1] for r in ids.select(_bucket(F.col(ids.columns[0]), modulus).alias("b")).groupBy("b").count().collect()}

    # ---- writes

    def stage(self, name: str, df: DataFrame) -> str:
        """Writes a new version of a table, not yet to be seen; gives its folder."""
        path = f"tables/{name}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{path}")
        return path

    def stage_keyed(self, name: str, df: DataFrame, key: str, rows: int) -> Entry:
        """Writes a new version of a keyed table, whole, not yet to be seen. rows is about how many it has."""
        wanted = max(1, -(-rows // self.rows_per_bucket))
        return self._write(name, df, {"key": key, "buckets": min(MOST_BUCKETS, 1 << (wanted - 1).bit_length()), "parts": {}}, {}, set())

    def restage(self, name: str, key: str, change: Callable[[DataFrame], DataFrame], ids: DataFrame | None) -> Entry:
        """A new version of a published table, not yet to be seen, in which change is made to the buckets of ids (nid).

        A change that writes keys of other buckets is an error; without ids it is made to all buckets, which takes in the layers. A plain table becomes a keyed one.
        """
        entry = self._last()[1][name]
        if isinstance(entry, str):
            old = self.staged(entry)
            return self.stage_keyed(name, change(old), key, old.count())
        residues = set(range(self._modulus(entry))) if ids is None else self._touched(entry, ids)
        if not residues:
            return entry
        if entry.get("layers") and ids is not None:
            entry = self._merged(name, entry)
            residues = self._touched(entry, ids)
        names = self._holders(entry, residues)
        kept = {p: path for p, path in entry["parts"].items() if p not in names}
        return self._write(name, change(self.staged(entry, residues)), entry, kept, names)

    def apply(self, name: str, key: str, rows: DataFrame | None = None, gone: DataFrame | None = None) -> Entry:
        """A new version of a published table, not yet to be seen, with rows in place of those with their keys, without the keys of gone (nid).

        Keys of rows are unique. Columns that rows don't have keep their values, and are null in new rows; new columns are null in old rows. Only rows and
        marks are written, until their bytes reach their share of the table.
        """
        entry = self._last()[1][name]
        if isinstance(entry, str):
            old = self.staged(entry)
            entry = self.stage_keyed(name, old, key, old.count())
        schema = T.StructType.fromJson(entry["schema"])
        parts = []
        if rows is not None:
            rows = rows.withColumn(NID, normal(rows, key))
            kept = [f.name for f in schema if f.name not in rows.columns]
            new = rows.select(*(F.col(f.name).cast(schema[f.name].dataType).alias(f.name) if f.name in schema.names else F.col(f.name) for f in rows.schema))
            schema = T.StructType([*schema.fields, *(f for f in rows.schema if f.name not in {*schema.names, NID})])
            if kept:  # a narrow read of the buckets that hold the keys
                held = self.staged(entry, self._touched(entry, rows.select(F.col(NID).alias("nid"))))
                new = new.join(held.select(normal(held, key).alias(NID), *kept), NID, "left")
            if gone is not None:
                new = new.join(gone.select(F.col("nid").alias(NID)), NID, "left_anti")
            parts.append(new.withColumn(GONE, F.lit(False)))
        if gone is not None:
            parts.append(gone.where("nid is not null").select(F.col("nid").alias(NID), F.lit(True).alias(GONE)).distinct())
        layer = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
        path = self.stage(name, layer.hint("rebalance"))
        written = self.spark.read.parquet(f"{self.root}/{path}")
        counts = self._rows_by_residue(written.select(NID), self._modulus(entry))
        if not counts:
            return entry
        layers = entry.get("layers") or []
        one = {"path": path, "number": layers[-1]["number"] + 1 if layers else 1, "rows": {str(r): n for r, n in counts.items()}, "bytes": self._bytes(path)}
        entry = entry | {"schema": schema.jsonValue(), "layers": [*layers, one]}
        over, under = sum(x["bytes"] for x in entry["layers"]), sum(b for _, b in entry["sizes"].values()) if entry.get("sizes") else 0
        return self._merged(name, entry) if over > self.share * under or len(entry["layers"]) > self.most_layers else entry

    def _merged(self, name: str, entry: dict) -> dict:
        """The table with its layers written into the buckets that they touch; too large ones are split."""
        n, modulus = entry["buckets"], self._modulus(entry)
        residues: dict[int, int] = {}
        for x in entry["layers"]:
            for r, rows in x["rows"].items():
                residues[int(r)] = residues.get(int(r), 0) + rows
        names, fine = self._holders(entry, set(residues)), set()
        for p in names:
            b, m = _named(p, n)
            rows = entry.get("sizes", {}).get(p, [0, 0])[0] + sum(k for r, k in residues.items() if r % m == b)
            times = 1
            while rows > 2 * self.rows_per_bucket * times and m * times < MOST_BUCKETS:
                times *= 2
            fine |= {_name(b + i * m, m * times, n) for i in range(times)}
        whole = {r for p in names for b, m in [_named(p, n)] for r in range(b, modulus, m)}
        kept = {p: path for p, path in entry["parts"].items() if p not in names}
        return self._write(name, self.staged(entry, whole), entry, kept, fine)

    def _write(self, name: str, df: DataFrame, entry: dict, kept: dict[str, str], names: set[str]) -> Entry:
        """The table with df's rows in buckets of those names, or else of the table's modulus, and kept as they are."""
        path, key, buckets = f"tables/{name}/{uuid.uuid4().hex}", entry["key"], entry["buckets"]
        nid = normal(df, key)
        by_modulus: dict[int, list[int]] = {}
        for p in names:
            b, m = _named(p, buckets)
            by_modulus.setdefault(m, []).append(b)
        bucket = _bucket(nid, buckets).cast("string")
        for m, residues in sorted(by_modulus.items()):  # the finest is asked first
            if m > buckets:
                bucket = F.when(_bucket(nid, m).isin(residues), F.concat(_bucket(nid, m).cast("string"), F.lit(f"-{m}"))).otherwise(bucket)
        # Rebalanced by bucket: small ones share a task, and one that is too large for a task is split.
        df.withColumn(BUCKET, bucket).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.root}/{path}")
        parts = {n.partition("=")[2]: f"{path}/{n}" for n, *_ in self._children(path) if n.startswith(f"{BUCKET}=")}
        if astray := kept.keys() & parts.keys():
            raise ValueError(f"{name}: a change wrote keys of buckets {sorted(astray)}, which it wasn't given")
        rows = {str(r[0]): r[1] for r in self.spark.read.parquet(f"{self.root}/{path}").groupBy(BUCKET).count().collect()} if parts else {}
        sizes = {p: s for p, s in (entry.get("sizes") or {}).items() if p in kept} | {p: [rows.get(p, 0), self._bytes(folder)] for p, folder in parts.items()}
        return {"key": key, "schema": df.schema.jsonValue(), "buckets": buckets, "parts": kept | parts, "sizes": sizes}

    # ---- manifests

    def claim(self) -> Claim:
        """The right to publish the next manifest, as a context manager; Busy where another job has it."""
        return Claim(self, self._last()[0] + 1)

    def publish(self, tables: dict[str, Entry], claim: Claim | None = None) -> None:
        """Makes staged versions the current ones, all at once, under a claim, or one that is taken for the moment."""
        if claim is None:
            with self.claim() as claim:
                return self.publish(tables, claim)
        claim.check()
        number, current = self._last()
        draft = f"drafts/{uuid.uuid4().hex}"
        self._create(draft, json.dumps(current | tables))
        fs, made = self._place(draft)
        _, target = self._place(f"manifests/{number + 1:012d}.json")
        fs.mkdirs(target.getParent())
        if fs.exists(target) or not fs.rename(made, target):
            raise Busy(f"another job has published manifest {number + 1}")

    def put(self, name: str, df: DataFrame) -> None:
        self.publish({name: self.stage(name, df)})

    # ---- what is sent to databases

    def note_sent(self, key: str, delta: str, gone: str | None) -> None:
        """Notes, before they are sent, the staged rows and removed ids of a job; forget takes the notes back."""
        self._create(f"sent/{key}/{uuid.uuid4().hex}.json", json.dumps({"delta": delta, "gone": gone}))

    def unfinished(self, key: str) -> list[dict]:
        """What jobs of that key have sent, or were about to, without being published."""
        return [json.loads(self._text(f"sent/{key}/{n}")) for n, *_ in self._children(f"sent/{key}") if n.endswith(".json")]

    def forget(self, key: str) -> None:
        fs, place = self._place(f"sent/{key}")
        fs.delete(place, True)

    def sweep(self, keep: int = 10, grace: float = 86400.0) -> list[str]:
        """Removes manifests but for the last ones, and folders of tables that none of these names; gives what went.

        Folders younger than grace (seconds) stay: a job that runs now may still publish them, or read them.
        """
        numbers, before = self._numbers(), (time.time() - grace) * 1000
        named: set[str] = set()
        for number in numbers[-keep:]:
            for entry in self._manifest(number).values():
                named |= {entry} if isinstance(entry, str) else {*entry["parts"].values(), *(x["path"] for x in entry.get("layers") or [])}
        for key, *_ in self._children("sent"):
            named |= {p for x in self.unfinished(key) for p in (x["delta"], x["gone"]) if p}
        above = {p.rpartition("/")[0] for p in named if f"/{BUCKET}=" in p}
        gone = [f"manifests/{k:012d}.json" for k in numbers[:-keep]]

        def walk(path: str) -> None:
            for child, folder, changed in self._children(path):
                one = f"{path}/{child}"
                if not folder or one in named:
                    continue
                if re.fullmatch("[0-9a-f]{32}", child) and one not in above or child.startswith(f"{BUCKET}="):
                    if changed < before:
                        gone.append(one)
                else:
                    walk(one)

        walk("tables")
        for path in gone:
            fs, place = self._place(path)
            fs.delete(place, True)
        return gone
