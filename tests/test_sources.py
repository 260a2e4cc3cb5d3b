import pytest
from pyspark.sql import functions as F

from certrisk.session import shared_dir
from certrisk.sources import captures
from certrisk.sources.captures import file_type, load_dataset, load_directory, load_single_file
from certrisk.sources.derived import make_der, spoil, write_files
from certrisk.sources.records import read_json, read_jsonl, write_json, write_jsonl
from datetime import date

DER = make_der("a.example", "Org", "DE", "CA", date(2020, 1, 1), date(2021, 1, 1), 2048, "RSA",
               "sha256WithRSAEncryption", ["a.example"])
TYPES = [
    (b"-----BEGIN CERTIFICATE-----\nMIIDXTCCAkWgAwIBAgIJAK...\n-----END CERTIFICATE-----", "pem"),
    (b"Certificate chain\n 0 s:CN=x\n---\n-----BEGIN CERTIFICATE-----\n...\n", "pem"),
    (b"Certificate chain\n 0 s:CN=x\n", "openssl_text"),
    ("Привет issuer=CN = x".encode(), "openssl_text"),
    ("Привет CONNECTED(00000003)".encode(), "openssl_text"),
    (b"Test certificate content", "openssl_text"),
    ("Привет".encode(), "unknown"),
    (b"", "unknown"),
    (b"0", "openssl_text"),
    (b"0" * 200, "openssl_text"),
    (b"\xff", "unknown"),
    (DER, "der"),
    (bytes([0x30, 0x80]) + b"\xff\xd0" * 80, "openssl_text"),
    (bytes([0x30, 0x80]) + "é".encode() * 80, "der"),
    (bytes([0x30, 0x20]) + bytes(range(32, 64)), "openssl_text"),
    (b"x" * 8192 + b"subject=".replace(b"s", "é".encode()), "openssl_text"),
]


def test_file_types(spark):
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(TYPES)], "i int, content binary")
    got = dict(df.select("i", file_type(F.col("content"))).collect())
    assert [got[i] for i in range(len(TYPES))] == [t for _, t in TYPES]


def test_plain_order_takes_binary_for_text(spark):
    df = spark.createDataFrame([(DER,)], "content binary")
    assert df.select(file_type(F.col("content"), der_first=False)).first()[0] == "openssl_text"


def test_text_decoding(spark):
    df = spark.createDataFrame([(b"a\r\nb\rc\xffd",)], "content binary")
    assert df.select(captures.decoded_text(F.col("content"))).first()[0] == "a\nb\nc�d"


@pytest.fixture()
def tree(tmp_path):
    for label in ("benign", "phishing"):
        for i in range(5):
            path = tmp_path / label / "deep" / f"cert {i}+x"
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(f"subject=CN = {label}{i}\n")
    (tmp_path / "top").write_bytes(DER)
    return tmp_path


def test_directory(spark, tree):
    rows = load_directory(spark, str(tree)).collect()
    assert len(rows) == 11
    assert sorted({(r.label, r.file_type) for r in rows}) == [
        ("benign", "openssl_text"), ("phishing", "openssl_text"), ("unknown", "der")]
    assert "cert 3+x" in {r.file_name for r in rows}
    der = next(r for r in rows if r.file_type == "der")
    assert bytes(der.content) == DER and der.text is None


def test_flat_directory_and_label_override(spark, tree):
    rows = load_directory(spark, str(tree), label="mine", recursive=False).collect()
    assert [(r.file_name, r.label) for r in rows] == [("top", "mine")]


def test_dataset_with_limit(spark, tree):
    rows = load_dataset(spark, str(tree), 3).collect()
    assert sorted(r.label for r in rows) == ["benign"] * 3 + ["phishing"] * 3
    again = load_dataset(spark, str(tree), 3).collect()
    assert {r.path for r in rows} == {r.path for r in again}


def test_dataset_without_a_class(spark, tmp_path):
    (tmp_path / "benign").mkdir()
    (tmp_path / "benign" / "c").write_text("content")
    assert [r.label for r in load_dataset(spark, str(tmp_path)).collect()] == ["benign"]
    with pytest.raises(FileNotFoundError):
        load_dataset(spark, str(tmp_path / "benign"))


def numbers_of_files(df):
    """Files the scans of a plan really opened."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    found, open_plans = [], [plan]
    while open_plans:
        at = open_plans.pop()
        if at.nodeName().startswith("Scan binaryFile"):
            found.append(at.metrics().get("numFiles").get().value())
        open_plans += [at.children().apply(i) for i in range(at.children().size())]
    return sorted(found)


def test_files_not_drawn_are_never_opened(spark, tree):
    """One undrawn file is too long to be read at all; another is damaged. Neither matters to the sample."""
    directory = str(tree / "benign")
    chosen = captures.capture_directory(spark, directory, sample_size=2)
    drawn = {r.path for r in chosen.listing(spark).collect()}
    assert len(drawn) == 2
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        for name in (tree / "benign" / "deep").iterdir():
            if f"file:{name}" not in drawn:
                name.write_text("x" * 5_000)
        rows = load_directory(spark, directory, sample_size=2, max_bytes=1 << 30)
        assert {r.path for r in rows.collect()} == drawn
        assert numbers_of_files(chosen.files(spark).select("content")) == [2]
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert load_directory(spark, directory, sample_size=0).count() == 0
    assert load_directory(spark, directory, sample_size=99).count() == 5


def test_bad_files_become_rows(spark, tree):
    long = tree / "benign" / "long"
    long.write_text("subject=CN = long\n" * 50)
    spark.createDataFrame([("damaged",)], "v string").coalesce(1).write.text(str(tree / "phishing" / "out"))
    (bad,) = (tree / "phishing" / "out").glob("part-*")
    with open(bad, "a") as f:
        f.write("!")
    chosen = captures.capture_dataset(spark, str(tree))
    rows = captures.read_all(spark, chosen, 500).collect()
    assert len(rows) == 11  # ten sound files and the long one
    assert [(r.file_name, r.label, r.content, r.text) for r in rows if r.file_type == "error"] == [("long", "benign", None, "")]
    sound = spark.createDataFrame([(r.path,) for r in rows if r.file_type != "error"], "path string")
    left = captures.unread(captures.list_all(spark, chosen), sound, 500).collect()
    assert sorted((r.file_name, r.label, r.file_type, r.reason) for r in left) == [
        ("long", "benign", "error", "longer than 500 bytes"), (bad.name, "phishing", "error", "unreadable")]


def test_exists(spark, tmp_path):
    assert captures.exists(spark, str(tmp_path)) and not captures.exists(spark, str(tmp_path / "none"))


def test_single_file(spark, tmp_path):
    (tmp_path / "cert").write_text("Test content")
    row = load_single_file(spark, str(tmp_path / "cert")).first()
    assert (row.file_name, row.text, row.label, row.file_type) == (
        "cert", "Test content", "unknown", "openssl_text")


def test_json_records(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    write_jsonl(df, str(tmp_path / "l"))
    assert sorted(read_jsonl(spark, str(tmp_path / "l"), df.schema).collect()) == sorted(df.collect())
    write_json(df.filter("a = 2"), str(tmp_path / "j"))
    assert read_json(spark, str(tmp_path / "j"), df.schema).collect() == [(2, "b")]


def test_content_is_not_read_for_a_path_listing(spark, tree):
    plan = captures.scan(spark, str(tree)).select("path")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<path:string>" in plan or "content" not in plan.split("Physical Plan")[1]


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_many_small_files_are_few_tasks(spark, tree):
    most = captures.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    for i in range(most):
        (tree / "benign" / f"more{i}").write_text(f"subject=CN = more{i}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        rows = load_directory(spark, str(tree))
        assert rows.rdd.getNumPartitions() <= most
        listing = captures.capture_directory(spark, str(tree)).listing(spark)
        assert listing.rdd.getNumPartitions() <= most
        assert rows.count() == listing.count() == 11 + most
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_a_file_for_each_row(spark, tmp_path, scheme):
    rows = [("benign", "a"), ("phishing", "a"), ("benign", "a"), ("benign", None), ("phishing", "é\nb")]
    df = spark.createDataFrame(rows, "label string, text string")
    write_files(df.repartition(3), f"{scheme}{tmp_path}/in")
    write_files(df.filter("label = 'none'"), f"{scheme}{tmp_path}/none", "run")
    found = sorted((p.parent.name, p.read_bytes()) for p in (tmp_path / "in").rglob("part-*"))
    assert found == sorted((label, f"{text or ''}\n".encode()) for label, text in rows)
    assert captures.load_dataset(spark, f"{tmp_path}/none").count() == 0
    spoil(spark, str(tmp_path / "in"), F.startswith("text", F.lit("a")))
    assert sorted(r.text for r in load_dataset(spark, str(tmp_path / "in")).collect()) == ["\n", "é\nb\n"]
    assert sorted(p.read_bytes() for p in (tmp_path / "in").rglob("part-*")) == sorted([b"a\n!"] * 3 + [b"\n", "é\nb\n".encode()])
