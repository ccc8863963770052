import pytest
from pyspark.sql import functions as F

from lakeferry import LOG_TABLES, SNAPSHOT_TABLES
from lakeferry.cli import main
from tests.conftest import rows


def run(spark, tmp_path, *arguments):
    tag = tmp_path.name.replace("-", "_")
    databases = ["--masked-db", f"m_{tag}", "--raw-db", f"r_{tag}"]
    places = ["--files", str(tmp_path), "--location", str(tmp_path / "lake")]
    main([*arguments, *databases, *places], spark)
    return f"m_{tag}", f"r_{tag}"


def filled(spec, text):
    times = dict.fromkeys(spec.datetimes, "2018-04-20 00:00:00")
    return [F.lit(times.get(column, text)).alias(column) for column in spec.columns]


def test_snapshot(spark, tmp_path):
    spec = SNAPSHOT_TABLES["cashier_relation"]
    frame = spark.range(2).select(*filled(spec, "13800008000"))
    frame.write.parquet(f"{tmp_path}/cashier_relation.parquet")
    masked, raw = run(spark, tmp_path, "snapshot", "cashier_relation", "--today", "2018/04/21")
    published = spark.table(f"{masked}.cashier_relation")
    assert rows(published.select("mobile")) == [("138****8000",)] * 2
    assert rows(spark.table(f"{raw}.cashier_relation_delta").select("yymmdd")) == [(20180420,)] * 2
    run(spark, tmp_path, "snapshot", "cashier_relation", "--today", "20180421")
    assert spark.table(f"{raw}.cashier_relation").count() == 2


def test_several_snapshots(spark, tmp_path):
    for name in ("areacode", "user_code"):
        columns = SNAPSHOT_TABLES[name].columns
        frame = spark.range(2).select(*[F.lit("x").alias(c) for c in columns])
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    asked = ["snapshot", "areacode", "user_code", "--today", "20180421", "--at-once", "2"]
    masked, raw = run(spark, tmp_path, *asked)
    for name in ("areacode", "user_code"):
        assert spark.table(f"{masked}.{name}").count() == spark.table(f"{raw}.{name}").count() == 2


def test_strict_snapshot_with_salt(spark, tmp_path):
    spec = SNAPSHOT_TABLES["user_bank"]
    frame = spark.range(1).select(*filled(spec, "6222"))
    frame.write.parquet(f"{tmp_path}/user_bank.parquet")
    (tmp_path / "salt").write_text("pepper\n")
    asked = ["snapshot", "user_bank", "--today", "20180421", "--strict"]
    masked, _ = run(spark, tmp_path, *asked, "--salt-file", str(tmp_path / "salt"))
    wanted = spark.sql("SELECT sha2('pepper6222', 256)").first()[0]
    assert spark.table(f"{masked}.user_bank").first().bank_card_id == wanted


def test_log_commands_and_other_names(spark, tmp_path):
    spec = LOG_TABLES["order_log"]
    for day in (20180420, 20180421):
        frame = spark.range(3).select(*filled(spec, "x"))
        frame.write.parquet(f"{tmp_path}/refund_log/yymmdd={day}")
    named = ["--columns-of", "order_log"]
    masked, raw = run(spark, tmp_path, "stage", "refund_log", "20180420", "20180421", *named)
    assert spark.table(f"{raw}.refund_log_delta").count() == 6
    run(spark, tmp_path, "days", "refund_log", "2018-04-20", "2018-04-21", *named)
    run(spark, tmp_path, "day", "refund_log", "2018-04-21", *named)
    published = spark.table(f"{masked}.refund_log")
    found = published.groupBy("yymmdd").agg(F.count("*"), F.count("red_price"))
    assert rows(found) == [(20180420, 3, 0), (20180421, 3, 3)]


def test_delimited_text_with_a_header(spark, tmp_path):
    """As the earlier loader left it: null tokens, zero dates, a separator."""
    lines = ["uid\x01person_card\x01realname\x01mobile\x01status\x01lasttime"]
    lines += ["1\x016222\x01Anna\x0113800008000\x011\x012018-04-20 01:02:03"]
    lines += ["2\x01\\N\x01\\N\x01\\N\x010\x010000-00-00 00:00:00"]
    (tmp_path / "user_auth.csv").write_text("\n".join(lines) + "\n")
    asked = ["snapshot", "user_auth", "--today", "20180421", "--format", "csv"]
    asked += ["--option", "header=true", "--option", "sep=\x01"]
    masked, raw = run(spark, tmp_path, *asked)
    found = spark.table(f"{masked}.user_auth")
    assert rows(found.select("uid", "realname", "mobile")) == [("1", "A**a", "138****8000"), ("2", None, None)]
    assert rows(spark.table(f"{raw}.user_auth").selectExpr("cast(lasttime AS string)")) == [
        ("2018-04-20 01:02:03",), (None,),
    ]
    (tmp_path / "columns").write_text("uid bigint, person_card string, realname string, mobile string, status int, lasttime string")
    run(spark, tmp_path, *asked, "--schema-file", str(tmp_path / "columns"))


def test_malformed_records(spark, tmp_path, capsys):
    spec = SNAPSHOT_TABLES["areacode"]
    good = "{" + ", ".join(f'"{c}": "x"' for c in spec.columns) + "}"
    (tmp_path / "areacode.json").write_text(f"{good}\n{good[:20]}\n{good}\n")
    (tmp_path / "columns").write_text(", ".join(f"{c} string" for c in spec.columns))
    asked = ["snapshot", "areacode", "--today", "20180421", "--format", "json"]
    asked += ["--schema-file", str(tmp_path / "columns")]
    with pytest.raises(Exception, match="(?i)malformed"):
        run(spark, tmp_path, *asked)
    masked, raw = run(spark, tmp_path, *asked, "--quarantine", str(tmp_path / "aside"))
    assert spark.table(f"{masked}.areacode").count() == spark.table(f"{raw}.areacode").count() == 2
    assert "1 malformed records of areacode" in capsys.readouterr().out


def test_unreadable_times(spark, tmp_path):
    spec = SNAPSHOT_TABLES["user_auth"]
    frame = spark.range(1).select(*filled(spec, "x")).withColumn("lasttime", F.lit("soon"))
    frame.write.parquet(f"{tmp_path}/user_auth.parquet")
    asked = ["snapshot", "user_auth", "--today", "20180421"]
    with pytest.raises(Exception, match="not a time: soon"):
        run(spark, tmp_path, *asked)
    masked, _ = run(spark, tmp_path, *asked, "--unreadable-times", "null")
    assert spark.table(f"{masked}.user_auth").first().lasttime is None


@pytest.mark.parametrize(
    "arguments",
    [
        ["snapshot", "nothing", "--today", "20180421", "--files", "/nowhere"],
        ["snapshot", "agency", "--files", "/nowhere"],
        ["days", "order_log", "soon", "20180421", "--files", "/nowhere"],
        ["day", "order_log", "20180421"],
        ["snapshot", "agency", "--today", "20180421", "--files", "/nowhere", "--strict"],
        ["snapshot", "agency", "--today", "20180421", "--files", "/nowhere", "--option", "header"],
    ],
)
def test_bad_calls_stop_early(arguments):
    with pytest.raises(SystemExit):
        main(arguments)
