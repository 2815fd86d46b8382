"""Zip archives of the feed -> text lines.

``binaryFile`` lists and reads the archives on executors (no driver I/O);
zip is not a splittable Hadoop codec, so each archive is one task.  The only
Python on executors is the unzip step (``mapInPandas``, Arrow batches), which
streams each member twice: once to see whether its bytes are valid UTF-8 (else
they are ISO-8859-1, which accepts every byte), once to hand on blocks of whole
lines.  So memory holds one archive and one block, however long a member is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20
BLOCK_SCHEMA = "path string, member string, block string"


def _unzip_fn(block_bytes: int):
    """The executor-side unzip, built in a local scope so it is shipped by value:
    workers need only the standard library and pandas, not this package."""
    def chunks(zf, name):
        with zf.open(name) as stream:
            while chunk := stream.read(block_bytes):
                yield chunk

    def encoding_of(zf, name):
        import codecs

        decoder = codecs.getincrementaldecoder("utf-8")()
        try:
            for chunk in chunks(zf, name):
                decoder.decode(chunk)
            decoder.decode(b"", final=True)
        except UnicodeDecodeError:
            return "iso-8859-1"
        return "utf-8"

    def blocks(zf, name):
        """Text up to the last line end of each chunk; a line longer than that grows on."""
        import codecs

        decoder = codecs.getincrementaldecoder(encoding_of(zf, name))()
        rest = []
        for chunk in chunks(zf, name):
            text = decoder.decode(chunk)
            end = text.rfind("\n")
            if end < 0:
                rest.append(text)
            else:
                yield "".join(rest) + text[:end]
                rest = [text[end + 1:]]
        yield "".join(rest) + decoder.decode(b"", final=True)

    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import zipfile

        import pandas as pd

        for batch in batches:
            for path, blob in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(blob)) as zf:
                    for name in zf.namelist():
                        for block in blocks(zf, name):
                            yield pd.DataFrame({"path": [path], "member": [name],
                                                "block": [block]})
    return unzip


def landed(spark: SparkSession, folder: str, name_glob: str = "*.zip") -> DataFrame:
    """(path, content) of the archives in ``folder`` whose names match.

    Without a use of ``content`` the names alone are listed and nothing is read.
    """
    return (spark.read.format("binaryFile").option("pathGlobFilter", name_glob)
            .load(folder).select("path", "content"))


def named(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, content) of the archives at these paths; no folder is listed."""
    if not paths:
        return spark.createDataFrame([], "path string, content binary")
    plain = [re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths]
    return spark.read.format("binaryFile").load(plain).select("path", "content")


def member_blocks(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Unzip ``(path, content)`` rows to (path, member, block of whole lines)."""
    return files.select("path", "content").mapInPandas(_unzip_fn(block_bytes), BLOCK_SCHEMA)


def member_lines(blocks: DataFrame, keep: Sequence[str] = ("path", "member")) -> DataFrame:
    """Split blocks on ``\\n`` into a ``value`` line column (blank lines kept)."""
    return blocks.select(*keep, F.explode(F.split("block", "\n", -1)).alias("value"))


def archive_lines(spark: SparkSession, folder: str, name_glob: str = "*.zip") -> DataFrame:
    return member_lines(member_blocks(landed(spark, folder, name_glob)))
