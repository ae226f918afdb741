"""Builds that publish complete and checked sets only, in one step.

    TARGET/versions/ID/TABLE/...   tables of one build, never changed
    TARGET/versions/ID/_manifest.json
    TARGET/commits/0000000007.json the seventh set: which version it is, and its manifest's hash
    TARGET/lease.json              who is writing, and until when

Tables are built in a version of their own and checked there; then inputs and code are looked at again. The set is
published by the one act of creating the next commit, which succeeds only if no file of that name is there: before it readers
see the old set, after it the new one, and of two writers that began from the same set one wins. A writer that dies leaves a
version that no commit names, and a lease that runs out; the next one clears up. The lease only spares work: what keeps
sets whole is the commit. No table is moved, so nothing depends on renaming folders.

Inputs and tables are told by their files (names, lengths and, for inputs, times), so publishing reads none of them again;
content hashes are taken where they are asked for. File calls go through Hadoop's file system, so targets may lie in any
store that Spark writes to whose rename of a file to an existing name fails (HDFS and its like; local disks by a link).
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession

from granary.operators.contracts import fail_if_any
from granary.plans.fingerprint import fingerprint
from granary.sources.measured import REPEATED, write_measured

MANIFEST = "_manifest.json"
VERSIONS, COMMITS, LEASE = "versions", "commits", "lease.json"
#: Seconds that a writer's lease holds; it is renewed after every table.
LEASE_SECONDS = 6 * 3600.0
#: Versions kept after a commit, for readers that have begun: the newest, and those before it.
KEEP = 2


class PublishError(RuntimeError):
    """A set that is incomplete, changed or built from something else."""


@dataclass(frozen=True)
class Job:
    """A table, how to build it from those before it, its checks, and measures of it that go to the manifest and may fail it too.

    observe, key: aggregates, and a key whose uniqueness is proven, both taken while the rows are written; a repeated key
    fails the job. judge: from what was observed and the metrics of the jobs before to further metrics, or an error. check
    and measure read the written table once more, each time they ask it something.
    """

    name: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    check: Callable[[DataFrame], None] = lambda df: None
    measure: Callable[[DataFrame, dict[str, DataFrame], dict], dict] = lambda df, tables, seen: {}
    observe: Mapping[str, Column] = field(default_factory=dict)
    key: Sequence[str] = ()
    judge: Callable[[dict, dict[str, dict]], dict] = lambda seen, before: {}


class Store:
    """Files below a folder, by Hadoop paths."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.conf, self.gateway = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._gateway
        self.fs = self.path(self.root).getFileSystem(self.conf)

    def at(self, name: str):
        return self.path(f"{self.root}/{name}")

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.at(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)

    def files(self, name: str = "", times: bool = False) -> list[list]:
        """Name below the folder and length of each file, and the time of its last change if asked for."""
        found, root = [], self.at(name) if name else self.path(self.root)
        if not self.fs.exists(root):
            return found
        prefix, walk = root.toUri().getPath(), self.fs.listFiles(root, True)
        while walk.hasNext():
            f = walk.next()
            own = f.getPath().toUri().getPath().removeprefix(prefix)
            if not own.endswith(".crc"):
                found.append([own, f.getLen(), *([f.getModificationTime()] if times else [])])
        return sorted(found)

    def names(self, folder: str) -> list[str]:
        at = self.at(folder)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def rename_new(self, a: str, b: str) -> bool:
        """Give the file a the name b, in one act, unless there is one of this name. On a local disk a keeps its name too."""
        if self.fs.getUri().getScheme() == "file":  # whose rename replaces
            files, own = self.jvm.java.nio.file.Files, lambda n: self.jvm.java.io.File(self.at(n).toUri().getPath()).toPath()
            act = lambda: files.createLink(own(b), own(a))
        else:
            rename = self.jvm.org.apache.hadoop.fs.Options.Rename
            options = self.gateway.new_array(rename, 1)
            options[0] = rename.NONE
            context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
            act = lambda: context.rename(self.at(a), self.at(b), options)
        try:
            act()
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def create(self, name: str, text: str) -> bool:
        """A file with this text, whole from the start, unless there is one of this name; whether it is ours."""
        folder, _, own = name.rpartition("/")
        draft = f"{folder}/.{own}.{uuid.uuid4().hex}".lstrip("/")
        self.write(draft, text)
        try:
            return self.rename_new(draft, name)
        finally:
            self.delete(draft)

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.at(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()


def code_fingerprint(*folders: str | Path) -> str:
    """Of all Python sources, with line ends alike."""
    h = hashlib.sha256()
    for folder in folders:
        for p in sorted(Path(folder).rglob("*.py")):
            h.update(f"{p.relative_to(folder)}\0".encode() + p.read_bytes().replace(b"\r\n", b"\n") + b"\0")
    return h.hexdigest()


def resolved(spark: SparkSession, path: str) -> str:
    """The path with its scheme, without `..`, and on a local disk without links."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toUri().normalize()
    own = jvm.java.io.File(uri.getPath()).getCanonicalPath() if uri.getScheme() == "file" else uri.getPath()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{own.rstrip('/')}/"


def protect_inputs(spark: SparkSession, target: str, inputs: Sequence[str]) -> None:
    """The target may neither hold an input nor lie in one, also by another spelling of the path or through a link."""
    out = resolved(spark, target)
    for i in inputs:
        own = resolved(spark, i)
        if out.startswith(own) or own.startswith(out):
            raise PublishError(f"{target} overlaps the input {i}")


def _described(store: Store, name: str, df: DataFrame, hashed: bool) -> dict:
    out = {"columns": [[f.name, f.dataType.simpleString()] for f in df.schema], "files": store.files(name), "rows": df.count()}  # a count reads footers only
    return out | ({"fingerprint": fingerprint(df).first().asDict()} if hashed else {})


def commits(store: Store, newest: int = KEEP) -> list[tuple[int, dict]]:
    """The last sets that were published, oldest first; older commits are listed but not read."""
    names = [n for n in store.names(COMMITS) if re.fullmatch(r"\d{10}\.json", n)]
    return [(int(n.split(".")[0]), json.loads(store.read(f"{COMMITS}/{n}"))) for n in names[-newest:]]


class Lease:
    """The right to build a new version, for some time. A lease that has run out can be taken over."""

    def __init__(self, store: Store, seconds: float):
        self.store, self.seconds, self.owner = store, seconds, uuid.uuid4().hex

    def _text(self) -> str:
        return json.dumps({"owner": self.owner, "until": time.time() + self.seconds})

    def _said(self) -> dict | None:
        try:
            return json.loads(self.store.read(LEASE))
        except Py4JJavaError:  # it went meanwhile
            return None

    def __enter__(self) -> Lease:
        for _ in range(2):
            if self.store.create(LEASE, self._text()):
                return self
            said = self._said()
            if said and said["until"] > time.time():
                raise PublishError(f"{self.store.root} is being written until {time.ctime(said['until'])}, by {said['owner']}")
            self.store.delete(LEASE)
        raise PublishError(f"another writer took {self.store.root} over")

    def held(self) -> bool:
        said = self._said()
        return said is not None and said["owner"] == self.owner

    def renew(self) -> None:
        if self.held():
            self.store.write(LEASE, self._text())

    def __exit__(self, *_) -> None:
        if self.held():
            self.store.delete(LEASE)


def clean(store: Store, keep: int = KEEP) -> None:
    """Delete the versions that none of the last `keep` commits names. Only for who holds the lease."""
    kept = {c["version"] for _, c in commits(store, keep)}
    for version in set(store.names(VERSIONS)) - kept:
        store.delete(f"{VERSIONS}/{version}")


def publish(
    spark: SparkSession, target: str, inputs: dict[str, str], jobs: Sequence[Job], code: str | Callable[[], str] = "",
    cross_check: Callable[[dict[str, DataFrame]], dict | None] | None = None, hashed: bool = False, lease_seconds: float = LEASE_SECONDS,
) -> dict:
    """Build all jobs from the inputs (name -> Parquet path) and publish them below target; returns the manifest.

    code: a fingerprint of the sources, or how to take it; that is done again before the commit. hashed: content hashes of
    the tables too, one pass over each. On any failure the set published before stays as it was, and the new version is
    removed. Where another writer holds the lease, or has published since this one began, it fails.
    """
    protect_inputs(spark, target, list(inputs.values()))
    store, version = Store(spark, target), uuid.uuid4().hex
    own = f"{VERSIONS}/{version}"
    read = lambda path: spark.read.parquet(path)
    look = lambda: ({n: Store(spark, p).files(times=True) for n, p in inputs.items()}, code() if callable(code) else code)
    with Lease(store, lease_seconds) as lease:
        last = max((n for n, _ in commits(store)), default=0)
        clean(store)  # what writers have left that died
        before = look()
        tables, manifest = {n: read(p) for n, p in inputs.items()}, {"code": before[1], "inputs": before[0], "tables": {}}
        try:
            for job in jobs:
                began = time.time()
                seen = write_measured(job.build(tables), f"{store.root}/{own}/{job.name}", job.observe, job.key)
                tables[job.name] = read(f"{store.root}/{own}/{job.name}")
                said = _described(store, f"{own}/{job.name}", tables[job.name], hashed)
                if said["rows"] != seen["rows"]:
                    raise PublishError(f"{job.name}: {said['rows']} rows in the files of {seen['rows']} written")
                fail_if_any({REPEATED: seen.pop(REPEATED, 0)}, job.name)
                metrics = seen | job.judge(seen, {n: m["metrics"] for n, m in manifest["tables"].items()})
                job.check(tables[job.name])  # the written table, not the plan that made it
                metrics |= job.measure(tables[job.name], tables, metrics)
                manifest["tables"][job.name] = said | {"seconds": round(time.time() - began, 3), "metrics": metrics}
                lease.renew()
            if cross_check:
                manifest["metrics"] = cross_check(tables) or {}
            now = look()
            if now[0] != before[0]:
                raise PublishError("an input changed during the build")
            if now[1] != before[1]:
                raise PublishError("the code changed during the build")
            text = json.dumps(manifest, indent=1, sort_keys=True, default=str)
            store.write(f"{own}/{MANIFEST}", text)
            if not store.create(f"{COMMITS}/{last + 1:010d}.json", json.dumps({"version": version, "manifest": _digest(text)})):
                raise PublishError("another writer published meanwhile")
        except BaseException:
            store.delete(own)
            raise
        if lease.held():
            clean(store)
    return manifest


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@dataclass(frozen=True)
class Published:
    """One published set: where it lies, and what it says of itself. It stays readable through KEEP - 1 later commits."""

    number: int
    path: str
    manifest: dict

    def paths(self) -> dict[str, str]:
        return {n: f"{self.path}/{n}" for n in self.manifest["tables"]}


def current(spark: SparkSession, target: str) -> Published | None:
    """The set that was published last, or None."""
    store = Store(spark, target)
    found = commits(store)
    if not found:
        return None
    number, said = found[-1]
    text = store.read(f"{VERSIONS}/{said['version']}/{MANIFEST}")
    if _digest(text) != said["manifest"]:
        raise PublishError(f"{target}: the manifest is not the published one")
    return Published(number, f"{store.root}/{VERSIONS}/{said['version']}", json.loads(text))


def load(spark: SparkSession, target: str, code: str | None = None, verify: bool = True, found: Published | None = None) -> dict[str, DataFrame]:
    """The tables published last (or those found before), if they are what the manifest says: their files, rows and columns, and hashes where it has some."""
    found = found or current(spark, target)
    if found is None:
        raise PublishError(f"{target}: nothing was published here")
    if code is not None and found.manifest["code"] != code:
        raise PublishError("the set was built by other code")
    store, tables = Store(spark, found.path), {}
    for n, said in found.manifest["tables"].items():
        files = store.files(n)
        if verify and files != said["files"]:
            raise PublishError(f"{n} is not what was published: other files")
        tables[n] = spark.read.parquet(f"{store.root}/{n}")
        if verify and (tables[n].count() != said["rows"] or [[f.name, f.dataType.simpleString()] for f in tables[n].schema] != said["columns"]):
            raise PublishError(f"{n} is not what was published: other rows or columns")
        if verify and "fingerprint" in said and fingerprint(tables[n]).first().asDict() != said["fingerprint"]:
            raise PublishError(f"{n} is not what was published: other contents")
    return tables
