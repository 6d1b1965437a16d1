"""The few file operations a table needs, on local disks and on any Hadoop file system."""

from __future__ import annotations

import os
import shutil
import uuid
from dataclasses import dataclass
from pathlib import Path
from urllib.parse import unquote, urlsplit

from pyspark.sql import SparkSession


# Schemes whose stores show an object only when it is closed, and what stores say of a name that is taken.
CONDITIONAL = ["s3a", "s3"]
TAKEN = ["FileAlreadyExists", "PreconditionFailed", "ConditionalRequestConflict", "PathAlreadyExists"]


@dataclass(frozen=True)
class Entry:
    path: str  # relative to the folder that was listed, not encoded
    size: int
    modified: int  # milliseconds


class LocalFiles:
    """Commits are claimed by a hard link, which exactly one of several writers gets."""

    def __init__(self, root: str):
        self.root = Path(unquote(urlsplit(root).path) if "://" in root else root)

    def names(self, folder: str) -> list[str]:
        at = self.root / folder
        return sorted(os.listdir(at)) if at.is_dir() else []

    def read(self, name: str) -> str:
        return (self.root / name).read_text(encoding="utf-8")

    def claim(self, name: str, text: str) -> bool:
        """Write a file that must not exist yet; false if it does. Readers see it whole or not at all."""
        at = self.root / name
        at.parent.mkdir(parents=True, exist_ok=True)
        draft = at.parent / f".{uuid.uuid4().hex}.tmp"
        with draft.open("w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(draft, at)
            return True
        except FileExistsError:
            return False
        finally:
            draft.unlink()

    def walk(self, folder: str) -> list[Entry]:
        at, out = self.root / folder, []
        for d, _, names in os.walk(at):
            for n in names:
                if not n.startswith((".", "_")):
                    p = Path(d) / n
                    s = p.stat()
                    out.append(Entry(str(p.relative_to(at)), s.st_size, int(s.st_mtime * 1000)))
        return sorted(out, key=lambda e: e.path)

    def move(self, old: str, new: str) -> None:
        to = self.root / new
        to.parent.mkdir(parents=True, exist_ok=True)
        os.rename(self.root / old, to)

    def delete(self, name: str) -> None:
        at = self.root / name
        shutil.rmtree(at, ignore_errors=True) if at.is_dir() else at.unlink(missing_ok=True)

    def local(self, name: str) -> str | None:
        """A path that this process can open."""
        return str(self.root / name)


class HadoopFiles:
    """A commit appears whole under its name, or not at all, and only if the name is free.

    On file systems with an atomic rename it is written as a draft and renamed to a name that must not exist. Object stores that show an
    object when its stream is closed, and only if no other has come first, get it by a conditional create.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self.conf)
        self.conditional = urlsplit(self.root).scheme.lower() in CONDITIONAL

    def path(self, name: str):
        base = self.jvm.org.apache.hadoop.fs.Path(self.root)
        return self.jvm.org.apache.hadoop.fs.Path(base, name) if name else base

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def _put(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def claim(self, name: str, text: str) -> bool:
        """Publish a file under a name that must be free; false if it is not."""
        try:
            if self.conditional:
                self._put(name, text)
                return True
            folder, _, last = name.rpartition("/")
            draft = f"{folder}/.{last}.{uuid.uuid4().hex}.tmp".lstrip("/")
            self._put(draft, text)
            try:
                self._rename_if_free(draft, name)
                return True
            finally:
                if self.fs.exists(self.path(draft)):
                    self.fs.delete(self.path(draft), False)
        except Exception as e:
            if any(m in str(e) for m in TAKEN):
                return False
            raise

    def _rename_if_free(self, old: str, new: str) -> None:
        to = self.path(new)
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        none = self.jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 1)
        none[0] = rename.NONE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.makeQualified(to).toUri(), self.conf).rename(self.path(old), to, none)

    def walk(self, folder: str) -> list[Entry]:
        at = self.path(folder)
        out, prefix = [], len(self.fs.makeQualified(at).toString()) + 1
        if self.fs.exists(at):
            found = self.fs.listFiles(at, True)
            while found.hasNext():
                s = found.next()
                rel = s.getPath().toString()[prefix:]
                if not s.getPath().getName().startswith((".", "_")):
                    out.append(Entry(rel, s.getLen(), s.getModificationTime()))
        return sorted(out, key=lambda e: e.path)

    def move(self, old: str, new: str) -> None:
        to = self.path(new)
        self.fs.mkdirs(to.getParent())
        if not self.fs.rename(self.path(old), to):
            raise OSError("a staged file could not be moved")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def local(self, name: str) -> str | None:
        return None


def files_of(spark: SparkSession, root: str) -> LocalFiles | HadoopFiles:
    """Local disks are asked directly; a path without a scheme is on the file system that Hadoop takes for the default."""
    local = root.startswith("file:/") or (root.startswith("/") and spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:"))
    return LocalFiles(root) if local else HadoopFiles(spark, root)
