"""Certificate captures on disk: any file name, type recognised by content."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from certrisk import constants as k
from certrisk.functions.text import count_in_class
from certrisk.operators.sampling import sample_per_class

#: Longest capture whose content is read.
MAX_BYTES = 64 << 20
#: Tasks that read files, for each core at most.
TASKS_PER_CORE = 2
ERROR = "error"


def has_path_part(path: Column, part: str) -> Column:
    return F.rlike(path, F.lit(f"(^|/){part}/"))


def path_label(path: Column) -> Column:
    """Class named by a directory of the path; ``phishing`` is looked for first."""
    return (F.when(has_path_part(path, "phishing"), "phishing")
            .when(has_path_part(path, "benign"), "benign").otherwise("unknown"))


def file_name(path: Column) -> Column:
    return F.try_url_decode(F.replace(
        F.substring_index(path, "/", -1), F.lit("+"), F.lit("%2B")))


def file_type(content: Column, der_first: bool = True) -> Column:
    """Type of a capture from its first 8,192 bytes.

    Binary certificates are mostly ASCII once undecodable bytes are dropped, so
    an ASCII test placed first takes them for text. ``der_first`` recognises the
    certificate header before that test; False keeps the plain order.
    """
    head = F.substring(content, 1, k.SNIFF_BYTES)
    marker = F.lit(False)
    for word in k.TEXT_MARKERS:
        marker = marker | F.contains(head, F.lit(word).cast("binary"))
    decoded = F.replace(F.make_valid_utf8(head.cast("string")), F.lit("�"), F.lit(""))
    ascii_share = 1 - count_in_class(decoded, r"^\x00-\x7F") / F.nullif(F.length(decoded), F.lit(0))
    start = F.hex(F.substring(content, 1, 2))
    big_enough = F.length(head) > k.MIN_DER_BYTES
    short_form = F.length(content) == F.conv(F.substring(start, 3, 2), 16, 10).try_cast("int") + 2
    der_header = F.rlike(start, F.lit("^308[1-4]")) | (F.rlike(start, F.lit("^30[0-7]")) & short_form)
    kind = F.when(content.isNull(), ERROR).when(
        F.contains(head, F.lit(k.PEM_BEGIN).cast("binary")), "pem").when(marker, "openssl_text")
    if der_first:
        kind = kind.when(big_enough & der_header, "der")
    return (kind.when(ascii_share > k.MIN_ASCII_SHARE, "openssl_text")
            .when(big_enough & F.startswith(start, F.lit("30")), "der").otherwise("unknown"))


def decoded_text(content: Column) -> Column:
    """UTF-8 with replacement characters and ``\\n`` line ends."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), r"\r\n?", "\n")


def with_content_columns(
    df: DataFrame, label: str | None = None, der_first: bool = True, keep: tuple[str, ...] = (),
) -> DataFrame:
    """``path, content`` to the raw-capture columns; works on streams as well. ``keep`` names further columns."""
    df = in_few_tasks(df).select(
        *keep, "path", F.col("content"),
        file_name(F.col("path")).alias("file_name"),
        file_type(F.col("content"), der_first).alias("file_type"),
        (F.lit(label) if label is not None else path_label(F.col("path"))).alias("label"))
    is_der = F.col("file_type") == "der"
    return df.select(
        *keep, "path", "file_name", "label", "file_type",
        F.when(is_der, F.col("content")).alias("content"),
        F.when(is_der, None).otherwise(
            F.coalesce(decoded_text(F.col("content")), F.lit(""))).alias("text"))


def in_few_tasks(files: DataFrame) -> DataFrame:
    """A scan of files, some tasks for each core at most.

    Spark counts a file as 4 MB and gives a task 32 small ones, which are read sooner than the expressions
    behind the scan are made ready, once for each task.
    """
    return files.coalesce(TASKS_PER_CORE * files.sparkSession.sparkContext.defaultParallelism)


def scan(spark: SparkSession, paths: str | list[str], recursive: bool = True) -> DataFrame:
    """File listing with lazily read content (``path, modificationTime, length, content``).

    A file that cannot be read has no row once ``content`` is asked for, but is listed without it. Names starting with ``_`` or ``.``
    are left out of directory listings by Spark; pass such files as explicit paths.
    """
    return (spark.read.format("binaryFile")
            .option("recursiveFileLookup", str(recursive).lower())
            .option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
            .load(paths))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or directory; lists no further than its top."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


@dataclass(frozen=True)
class CaptureFiles:
    """The captures of one directory: all of them, or those whose path hash is not above ``cut``.

    The cut is a literal on the file path alone, so Spark drops other files while it lists
    them, before any content is opened.
    """

    directory: str
    label: str | None = None
    recursive: bool = True
    cut: str | None = None
    seed: int = 42

    def files(self, spark: SparkSession) -> DataFrame:
        files = scan(spark, self.directory, self.recursive)
        if self.cut is None:
            return files
        return files.filter(F.md5(F.concat(F.col("_metadata.file_path"), F.lit(f"#{self.seed}"))) <= self.cut)

    def sampled(self, spark: SparkSession, n: int) -> CaptureFiles:
        """``n`` files, the same ones in every run: those with the smallest path hashes."""
        paths = scan(spark, self.directory, self.recursive).select(
            F.col("_metadata.file_path").alias("path"), F.lit("all").alias("label"))
        drawn = sample_per_class(paths, "label", "path", n, self.seed)
        cut = drawn.agg(F.max(F.md5(F.concat("path", F.lit(f"#{self.seed}"))))).first()[0]
        return CaptureFiles(self.directory, self.label, self.recursive, cut or "", self.seed)

    def listing(self, spark: SparkSession) -> DataFrame:
        """``path, length, label``; no content is read."""
        path = F.col("path")
        return in_few_tasks(self.files(spark).select("path", "length")).select(
            "path", "length", (F.lit(self.label) if self.label is not None else path_label(path)).alias("label"))

    def read(self, spark: SparkSession, max_bytes: int = MAX_BYTES, der_first: bool = True) -> DataFrame:
        """Raw captures; a file above ``max_bytes`` is an ``error`` row, a file that cannot be read has none yet (see ``unread``)."""
        files = self.files(spark)
        # Two scans of one listing: the length decides, before reading, which of them has the content.
        short = files.filter(F.col("length") <= max_bytes).select("path", "content")
        long = files.filter(F.col("length") > max_bytes).select("path", F.lit(None).cast("binary").alias("content"))
        return with_content_columns(short.unionByName(long), self.label, der_first)


def capture_directory(
    spark: SparkSession, directory: str, label: str | None = None, sample_size: int | None = None,
    recursive: bool = True, seed: int = 42,
) -> CaptureFiles:
    chosen = CaptureFiles(directory, label, recursive, None, seed)
    return chosen if sample_size is None else chosen.sampled(spark, sample_size)


def capture_dataset(
    spark: SparkSession, directory: str, sample_size_per_class: int | None = None, seed: int = 42,
) -> list[CaptureFiles]:
    """``benign/`` and ``phishing/`` below a directory. A missing class directory counts as empty."""
    root = directory.rstrip("/")
    found = [capture_directory(spark, f"{root}/{label}", label, sample_size_per_class, True, seed)
             for label in ("benign", "phishing") if exists(spark, f"{root}/{label}")]
    if not found:
        raise FileNotFoundError(f"neither benign/ nor phishing/ below {directory}")
    return found


def together(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_all(spark: SparkSession, chosen: list[CaptureFiles], max_bytes: int = MAX_BYTES, der_first: bool = True) -> DataFrame:
    return together([c.read(spark, max_bytes, der_first) for c in chosen])


def list_all(spark: SparkSession, chosen: list[CaptureFiles]) -> DataFrame:
    return together([c.listing(spark) for c in chosen])


def unread(listing: DataFrame, done: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Listed files that have no row in ``done`` (``path``), as raw ``error`` rows with ``length`` and ``reason``.

    Paths alone are compared; what was read is not read again.
    """
    left = listing.join(done.select("path"), "path", "left_anti")
    reason = F.when(F.col("length") > max_bytes, F.lit(f"longer than {max_bytes} bytes")).otherwise("unreadable")
    return left.select(
        "path", file_name(F.col("path")).alias("file_name"), "label", F.lit(ERROR).alias("file_type"),
        F.lit(None).cast("binary").alias("content"), F.lit("").alias("text"), "length", reason.alias("reason"))


def load_directory(
    spark: SparkSession, directory: str, label: str | None = None,
    sample_size: int | None = None, recursive: bool = True, der_first: bool = True,
    seed: int = 42, max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """Every regular file of a directory as a raw capture.

    With ``sample_size`` the sample is drawn on paths alone; other files are never opened.
    """
    return capture_directory(spark, directory, label, sample_size, recursive, seed).read(spark, max_bytes, der_first)


def load_dataset(
    spark: SparkSession, directory: str, sample_size_per_class: int | None = None,
    der_first: bool = True, seed: int = 42, max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """``benign/`` and ``phishing/`` below a directory, each with its label."""
    return read_all(spark, capture_dataset(spark, directory, sample_size_per_class, seed), max_bytes, der_first)


def load_single_file(spark: SparkSession, path: str, der_first: bool = True, max_bytes: int = MAX_BYTES) -> DataFrame:
    """One capture. As nothing else says that it could not be read, reading fails where it fails."""
    files = spark.read.format("binaryFile").load(path).filter(F.col("length") <= max_bytes)
    return with_content_columns(files.select("path", "content"), None, der_first)
