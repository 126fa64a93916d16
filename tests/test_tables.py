import datetime
import json
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tierflow.plans import contracts
from tierflow.plans.gold import SUMMARY_COLUMNS, atm_behaviour, customer_summary
from tierflow.plans.silver import customer_dimension, enriched_transactions
from tierflow.session import scratch
from tierflow.sources import sinks, storage
from tierflow.sources.files import scan_table
from tierflow.sources.jdbc import config_values, jdbc_options
from tierflow.streaming.append import append_stream, stream_files
from tierflow.streaming.ingest import ingest_files, read_ingested, stored_schema
from tierflow.streaming.upsert import current_rows, fold, upsert_stream

AT = datetime.datetime(2026, 3, 29, 6)


class Landing:
    def __init__(self, spark, name):
        self.spark, self.root, self.loads = spark, scratch(spark, name), 0
        self.table = f"{self.root}/table"

    def land(self, data, schema, files=1):
        self.loads += 1
        df = self.spark.createDataFrame(data, schema).coalesce(files)
        df.write.parquet(f"{self.root}/in/2026/03/{self.loads:02d}")

    def ingest(self, **kwargs):
        ingest_files(
            self.spark, f"{self.root}/in", self.table, f"{self.root}/check", ingested_at=AT, **kwargs
        )

    def read(self):
        return read_ingested(self.spark, self.table)


@pytest.fixture
def landing(spark, request):
    return Landing(spark, request.node.name.split("[")[0])


def test_ingest_appends_evolves_and_rescues(landing):
    landing.land([(1, 1.5)], "k bigint, v double")
    landing.ingest()
    landing.ingest()
    assert landing.read().count() == 1
    landing.land([(2, 2.5, "x")], "k bigint, v double, extra string")
    landing.ingest()
    landing.land([("3", "oops"), ("x4", "4.5")], "k string, v string")
    landing.ingest()
    got = {r.v or r.k or 0: r for r in landing.read().collect()}
    assert len(got) == 4
    assert got[1.5].extra is None and got[1.5]._rescued_data is None
    assert got[2.5].extra == "x"
    assert got[3].k == 3 and json.loads(got[3]._rescued_data)["v"] == "oops"
    assert got[4.5].k is None and json.loads(got[4.5]._rescued_data)["k"] == "x4"
    assert {r.FechaIngestaDatos for r in got.values()} == {AT}
    assert landing.read().columns == ["FechaIngestaDatos", "k", "v", "extra", "_rescued_data"]


def test_conflicting_types_in_one_batch(landing):
    landing.land([(1, 1)], "k bigint, v int")
    landing.land([(2, 2.75)], "k bigint, v double")
    landing.land([(3, "abc")], "k bigint, v string")
    landing.ingest()
    kept = {r.k: (r.v, r._rescued_data) for r in landing.read().collect()}
    assert len(kept) == 3
    assert kept[1] == (1, None)
    assert kept[2][0] is None and json.loads(kept[2][1])["v"] == 2.75
    assert kept[3][0] is None and json.loads(kept[3][1])["v"] == "abc"


def test_unknown_columns_are_rescued_without_evolution(landing):
    landing.land([(1,)], "k bigint")
    landing.ingest(evolve=False)
    landing.land([(2, "x")], "k bigint, extra string")
    landing.ingest(evolve=False)
    by_key = {r.k: r._rescued_data for r in landing.read().collect()}
    assert by_key[1] is None and json.loads(by_key[2])["extra"] == "x"
    assert "extra" not in landing.read().columns


def test_empty_landing_folder_is_legal(spark, landing):
    spark._jvm.org.apache.hadoop.fs.Path(f"{landing.root}/in").getFileSystem(
        spark._jsc.hadoopConfiguration()
    ).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(f"{landing.root}/in"))
    landing.ingest()
    assert stored_schema(spark, landing.table, "main") is None
    assert landing.read().count() == 0
    landing.land([(1,)], "k bigint")
    landing.ingest()
    assert landing.read().count() == 1


def test_small_batches_and_second_flow(spark, landing):
    landing.land([(i,) for i in range(12)], "k bigint", files=4)
    landing.land([(i,) for i in range(12, 20)], "k bigint", files=4)
    landing.ingest(max_files=1)
    assert sorted(r.k for r in landing.read().collect()) == list(range(20))
    with pytest.raises(ValueError, match="flow"):
        ingest_files(spark, f"{landing.root}/in", landing.table, f"{landing.root}/other")
    ingest_files(
        spark, f"{landing.root}/in", landing.table, f"{landing.root}/other", flow="second"
    )
    both = read_ingested(spark, landing.table, flows=["main", "second"])
    assert both.count() == 40


def test_glob_characters_in_landed_names(spark, landing):
    spark.range(2).write.parquet(f"{landing.root}/in/load[{{1}}]")
    spark.range(2, 5).write.parquet(f"{landing.root}/in/load1")
    landing.ingest()
    assert sorted(r.id for r in landing.read().collect()) == [0, 1, 2, 3, 4]


def test_replayed_batch_changes_nothing(spark, landing):
    """Losing the last commit of the checkpoint makes the stream run the batch again."""
    landing.land([(1,)], "k bigint")
    landing.ingest()
    fs, commit = storage._open(spark, f"{landing.root}/check/commits/0")
    assert fs.delete(commit, False)
    landing.ingest()
    assert [r.k for r in landing.read().collect()] == [1]


def test_unfinished_batch_is_replaced(spark, landing):
    landing.land([(1,)], "k bigint")
    landing.ingest()
    for lost in ("check/commits/0", "table/flow=main/batch_id=0/_SUCCESS"):
        fs, path = storage._open(spark, f"{landing.root}/{lost}")
        assert fs.delete(path, False)
    landing.ingest()
    assert [r.k for r in landing.read().collect()] == [1]


def test_late_and_oddly_named_files_are_taken(spark, landing):
    landing.land([(k,) for k in range(5)], "k bigint")
    landing.ingest()
    landing.land([(k,) for k in range(5, 8)], "k bigint")
    folder = f"{landing.root}/in/2026/03/02"
    fs, target = storage._open(spark, folder)
    for status in fs.listStatus(target):
        name = status.getPath().getName()
        if name.endswith(".parquet"):
            odd = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name.removesuffix('.parquet')}.parq")
            assert fs.rename(status.getPath(), odd)
    storage.set_age(spark, folder, 30)
    landing.ingest()
    assert sorted(r.k for r in landing.read().collect()) == list(range(8))


def test_late_files_reach_an_appending_stream(spark):
    root = scratch(spark, "late-append")
    schema = spark.range(1).schema
    for i in range(2):
        spark.range(5).write.parquet(f"{root}/in/load{i}")
        if i:
            storage.set_age(spark, f"{root}/in/load{i}", 30)
        append_stream(stream_files(spark, schema, f"{root}/in/*"), f"{root}/out", f"{root}/check")
    assert spark.read.parquet(f"{root}/out").count() == 10


def test_batches_without_a_commit_mark_are_not_read(spark, landing):
    landing.land([(1,)], "k bigint")
    landing.ingest()
    folder = f"{landing.table}/flow=main/batch_id=99"
    landing.read().write.parquet(folder)
    fs, mark = storage._open(spark, f"{folder}/_SUCCESS")
    assert fs.delete(mark, False)
    assert landing.read().count() == 1


def test_flows_of_different_types_are_read_together(spark, landing):
    landing.land([(1, 10)], "k bigint, v bigint")
    landing.ingest()
    landing.land([(2, "20"), (3, "x")], "k bigint, v string")
    ingest_files(
        spark, f"{landing.root}/in/2026/03/02", landing.table, f"{landing.root}/other",
        flow="second", ingested_at=AT,
    )
    got = {r.k: r for r in read_ingested(spark, landing.table, flows=["main", "second"]).collect()}
    assert {k: r.v for k, r in got.items()} == {1: 10, 2: 20, 3: None}
    assert json.loads(got[3]._rescued_data)["v"] == "x"


def test_view_versions(spark, as_rows):
    root = scratch(spark, "view")
    with pytest.raises(ValueError):
        sinks.current_view(spark, root)
    first = sinks.refresh_view(spark.range(3), root)
    sinks.refresh_view(sinks.current_view(spark, root).filter("id > 0"), root)
    assert as_rows(sinks.current_view(spark, root)) == [(1,), (2,)]
    assert spark.read.parquet(first).count() == 3
    sinks.refresh_view(spark.range(0), root)
    assert as_rows(sinks.current_view(spark, root)) == []


def test_clustered_files_have_disjoint_ranges_and_split_hot_values(spark):
    """A third of the rows are copies of one row; no file may hold them all."""
    path = scratch(spark, "clustered")
    hot = spark.range(0, 30000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000).alias("k"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"),
    )
    sinks.write_clustered(hot, path, ["k"], 8)
    files = sorted(Path(path).glob("*.parquet"))
    ranges, sizes = [], []
    for file in files:
        meta = pq.ParquetFile(file).metadata
        if meta.num_rows:
            stats = [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups)]
            ranges.append((min(s.min for s in stats), max(s.max for s in stats)))
            sizes.append(meta.num_rows)
    ranges.sort()
    assert sum(sizes) == 30000
    assert max(sizes) < 10000
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_compaction_packs_small_files(spark, as_rows):
    root = scratch(spark, "compact")
    sinks.write_files(spark.range(1000), f"{root}/many", 40)
    planned = sinks.compact(spark, f"{root}/many", f"{root}/few")
    assert planned == 1
    assert len(spark.read.parquet(f"{root}/few").inputFiles()) == 1
    assert as_rows(spark.read.parquet(f"{root}/few")) == sorted([(i,) for i in range(1000)], key=repr)
    sinks.compact(spark, f"{root}/many", f"{root}/half", target_bytes=12_000)
    assert 1 < len(spark.read.parquet(f"{root}/half").inputFiles()) < 40


def test_upsert_keeps_newest_over_late_rows_and_folds(spark, as_rows):
    root, rule = scratch(spark, "upsert"), (["k"], ["seq"], ["id"])
    schema = "k int, seq int, id int"
    loads = [[(1, 5, 1), (2, 1, 2)], [(1, 3, 3), (3, 1, 4)], [(2, 9, 5), (2, 9, 6)]]
    for i, rows in enumerate(loads):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        upsert_stream(stream, f"{root}/t", f"{root}/check", *rule)
        if i == 1:
            fold(spark, f"{root}/t", *rule)
            fold(spark, f"{root}/t", *rule)
    expected = [(1, 5, 1), (2, 9, 6), (3, 1, 4)]
    assert as_rows(current_rows(spark, f"{root}/t", *rule)) == expected
    fold(spark, f"{root}/t", *rule)
    assert as_rows(current_rows(spark, f"{root}/t", *rule)) == expected
    with pytest.raises(ValueError):
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        upsert_stream(stream, f"{root}/t", f"{root}/new_check", *rule)


def test_config_values(spark):
    config = spark.createDataFrame(
        [(k, f"value of {k}") for k in ("datalake", "catalog")], "Clave string, Valor string"
    )
    assert config_values(config, ["datalake"]) == {"datalake": "value of datalake"}
    with pytest.raises(ValueError, match="absent"):
        config_values(config, ["datalake", "absent"])


def test_catalog_scan(spark):
    spark.range(3).createOrReplaceTempView("three_rows")
    assert scan_table(spark, "three_rows").count() == 3


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "dbo.Parametros")
    assert plain == {"url": "jdbc:x", "dbtable": "dbo.Parametros", "fetchsize": "10000"}
    split = jdbc_options("jdbc:x", "t", split_on="id", low=0, high=100, splits=4)
    assert split["numPartitions"] == "4" and split["upperBound"] == "100"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", split_on="id")


def bronze(spark, contract, rows):
    """Contract-shaped rows from partial dicts, plus the ingest columns."""
    schema = contracts.source_schema(contract)
    schema.add("FechaIngestaDatos", "timestamp").add("_rescued_data", "string")
    for field in schema.fields:
        field.nullable = True
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


@pytest.fixture
def bank(spark):
    old, new = AT, AT + datetime.timedelta(days=1)
    trx = datetime.date(2026, 3, 1)
    person = {"CRDSCR": 450, "RISKLV": "04", "SGMNT": "VIP", "TTLPRD": 9, "ACCTST": "AC", "LSTTRX": trx}
    master = bronze(
        spark,
        contracts.MASTER,
        [
            {"CUSTID": 1, "CUSTNM": "old name", "FechaIngestaDatos": old, **person},
            {"CUSTID": 1, "CUSTNM": "new name", "FechaIngestaDatos": new, **person},
            {"CUSTID": 2, "CUSTNM": "no account", "FechaIngestaDatos": old, **person},
            {"CUSTID": None, "CUSTNM": "nobody", "FechaIngestaDatos": old},
        ],
    )
    balances = bronze(
        spark,
        contracts.BALANCES,
        [
            {"CUSTID": 1, "OVDST": "SI", "AVLBAL": 250000.0, "CRDLMT": 150000.0, "FechaIngestaDatos": old},
            {"CUSTID": 9, "OVDST": "SI", "AVLBAL": 1.0, "FechaIngestaDatos": old},
        ],
    )
    transactions = bronze(
        spark,
        contracts.TRANSACTIONS,
        [
            {"TRXID": 1, "CUSTID": 1, "TRXTYP": "CATM", "TRXAMT": 100.0, "ORGAMT": 100.0, "FEEAMT": 2.0},
            {"TRXID": 2, "CUSTID": 1, "TRXTYP": "CATM", "ORGAMT": 0.0, "NETAMT": 5.0, "TAXAMT": 1.0},
            {"TRXID": 3, "CUSTID": 1, "TRXTYP": "PGSL", "TRXAMT": 40.0, "BLNBFR": 10.0, "BLNAFT": 4.0},
            {"TRXID": 4, "CUSTID": None, "TRXTYP": "DATM", "TRXAMT": 9.0},
            {"TRXID": 5, "CUSTID": 7, "TRXTYP": "CMPR", "TRXAMT": 9.0, "PNLAMT": 1.0},
        ],
    )
    return master, balances, transactions


def test_customer_dimension(bank):
    master, balances, _ = bank
    made = customer_dimension(master, balances, datetime.date(2026, 3, 30))
    assert len(made.columns) == 175
    assert made.columns[:2] == ["huella_identificacion_cliente", "identificador_cliente"]
    by_key = {r.identificador_cliente: r for r in made.collect()}
    assert set(by_key) == {1, 2}
    assert by_key[1].nombre_completo_cliente == "new name"
    assert by_key[1].clasificacion_riesgo_cliente == "RIESGO_CRITICO"
    assert by_key[1].categoria_saldo_disponible == "SALDO_PREMIUM"
    assert by_key[1].perfil_actividad_bancaria == "CLIENTE_INTEGRAL"
    assert len(by_key[1].huella_identificacion_cliente) == 64
    assert by_key[2].clasificacion_riesgo_cliente == "RIESGO_MEDIO"
    assert by_key[2].categoria_saldo_disponible == "SALDO_CRITICO"
    assert by_key[2].saldo_disponible is None


def test_enriched_transactions_and_gold(bank):
    master, balances, transactions = bank
    silver = enriched_transactions(transactions)
    assert len(silver.columns) == 65
    assert silver.columns[:3] == ["fecha_transaccion", "identificador_cliente", "tipo_transaccion"]
    by_id = {r.identificador_transaccion: r for r in silver.collect()}
    assert by_id[1].porcentaje_comision_sobre_monto == 2.0
    assert by_id[2].porcentaje_comision_sobre_monto == 0.0
    assert by_id[2].monto_neto_comisiones == 4.0
    assert by_id[3].variacion_saldo_transaccion == 6.0
    assert by_id[5].indicador_impacto_financiero == 10.0
    behaviour = atm_behaviour(silver)
    assert {tuple(r) for r in behaviour.collect()} == {(1, 2, 0, 50.0, 0.0, 40.0), (7, 0, 0, 0.0, 0.0, 0.0)}
    customers = customer_dimension(master, balances, datetime.date(2026, 3, 30))
    summary = customer_summary(customers, behaviour)
    assert len(summary.columns) == 22 and set(SUMMARY_COLUMNS) < set(summary.columns)
    metrics = {r.identificador_cliente: tuple(r)[-5:] for r in summary.collect()}
    assert metrics == {1: (2, 0, 50.0, 0.0, 40.0), 2: (0, 0, 0.0, 0.0, 0.0)}


@pytest.mark.parametrize(
    "contract, counts",
    [
        (contracts.MASTER, {"string": 41, "date": 18, "bigint": 8, "double": 3}),
        (contracts.TRANSACTIONS, {"string": 7, "date": 19, "timestamp": 2, "bigint": 2, "double": 30}),
        (contracts.BALANCES, {"string": 29, "date": 35, "bigint": 2, "double": 34}),
    ],
)
def test_contract_types(contract, counts):
    kinds = [f.dataType.simpleString() for f in contracts.source_schema(contract).fields]
    assert {k: kinds.count(k) for k in set(kinds)} == counts
def test_refresh_takes_only_new_facts_and_counts_drops(spark):
    from tierflow.plans.pipeline import ingest_bronze, refresh_all

    root = scratch(spark, "product")
    landing = {name: f"{root}/landing/{name}" for name in ("cmstfl", "trxpfl", "blncfl")}

    def land(load, name, contract, rows):
        layout = contracts.source_schema(contract)
        made = [tuple(r.get(f.name) for f in layout.fields) for r in rows]
        nullable = "CUSTID" if name == "cmstfl" else None
        layout.fields = [type(f)(f.name, f.dataType, f.nullable or f.name == nullable) for f in layout.fields]
        spark.createDataFrame(made, layout).coalesce(1).write.parquet(f"{landing[name]}/{load}")

    land(1, "cmstfl", contracts.MASTER, [{"CUSTID": 1}, {"CUSTID": None}])
    land(1, "blncfl", contracts.BALANCES, [{"CUSTID": 1}])
    land(1, "trxpfl", contracts.TRANSACTIONS, [{"TRXID": 1, "CUSTID": 1, "TRXTYP": "CATM", "TRXAMT": 5.0}])
    reports = []
    for load in (1, 1, 2):
        if load == 2:
            land(2, "trxpfl", contracts.TRANSACTIONS, [{"TRXID": 2, "CUSTID": 1, "TRXTYP": "CATM", "TRXAMT": 7.0}])
        ingest_bronze(spark, landing, root, AT)
        reports.append({})
        tables = refresh_all(spark, root, report=reports[-1])
    assert [r["fact_batches_written"] for r in reports] == [1, 0, 1]
    assert reports[0]["clientes_saldos_consolidados"] == 1
    facts = tables["transacciones_enriquecidas"].collect()
    assert sorted(r.identificador_transaccion for r in facts) == [1, 2]
    summary = tables["resumen_integral_cliente"].collect()
    assert [r.promedio_monto_depositos_atm for r in summary] == [6.0]


