"""Sources, sinks and streaming on small source-shaped fixtures written to a fresh temp folder."""

import base64
import io
import json
import os
import zipfile

import pytest

from pyspark.sql import functions as F

from tessera.functions.messages import decode_message, message_status
from tessera.operators import macro, panel
from tessera.plans import rows_only
from tessera.sinks import tables
from tessera.sources import archives, landed, series
from tessera.streaming import incremental, triggered


def _write(path, text, encoding="ISO-8859-1"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(text.encode(encoding))


EST_ROW = ('"{b}";"0001";"{dv}";"1";"{name}";"{sit}";"20200101";"00";"";"";"20100315";"{cnae}";"";"RUA";'
           '"X";"1";"";"CENTRO";"01001000";"SP";"7107";"11";"5555";"";"";"";"";"a@b.c";"";""')


def _establishments(root):
    rows_a = [EST_ROW.format(b="00012345", dv="91", name="CAFÉ SÃO JOÃO", sit="02", cnae="0111301"),
              EST_ROW.format(b="00099999", dv="10", name='BAR "DO ZÉ"'.replace('"', '""'), sit="08", cnae="4711302"),
              '"00077777";"0001";"55";"1";"LINHA\nQUEBRADA";"04"',                       # short row + quoted newline
              EST_ROW.format(b="00011111", dv="01", name="", sit="02", cnae="0111301") + ';"extra";"more"']
    _write(f"{root}/2024-01/K3241.K03200Y0.D40113.ESTABELE", "\n".join(rows_a) + "\n")
    _write(f"{root}/2024-02/K3241.K03200Y0.D40213.ESTABELE",
           EST_ROW.format(b="00012345", dv="91", name="CAFÉ SÃO JOÃO", sit="08", cnae="0111301") + "\n")
    _write(f"{root}/2024-02/readme.txt", "not a data file")


def test_registry_csv_dialect(spark, tmp_dir):
    root = f"{tmp_dir}/estabelecimentos"
    _establishments(root)
    df = landed.read_registry(spark, root, "estabelecimentos")
    rows = {(r.cnpj_basico, r.ano_mes): r for r in df.collect()}
    assert len(rows) == 5
    a = rows[("00012345", "2024-01")]
    assert a.nome_fantasia == "CAFÉ SÃO JOÃO" and a.situacao_cadastral == "02" and a.cnae_fiscal_principal == "0111301"
    assert rows[("00099999", "2024-01")].nome_fantasia == 'BAR "DO ZÉ"'
    short = rows[("00077777", "2024-01")]
    assert short.nome_fantasia == "LINHA\nQUEBRADA" and short.situacao_cadastral == "04" and short.uf is None
    assert rows[("00011111", "2024-01")].data_situacao_especial is None     # extra fields ignored
    assert rows[("00012345", "2024-02")].situacao_cadastral == "08"
    pruned = landed.read_registry(spark, root, "estabelecimentos", periods=["2024-02"])
    assert pruned.count() == 1
    assert [r.ano_mes for r in landed.available_periods(spark, root).collect()] == ["2024-01", "2024-02"]


def test_load_status_and_partition_overwrite(spark, tmp_dir):
    root = f"{tmp_dir}/estabelecimentos"
    _establishments(root)
    _write(f"{root}/2024-02/bad.ESTABELE", '"12X";"0001"\n')
    df = landed.read_registry(spark, root, "estabelecimentos")
    status = {r.ano_mes: r for r in tables.load_status(df, ["ano_mes"], landed.bad_registry_rows(df), 0).collect()}
    assert status["2024-01"].status == "success" and status["2024-02"].status == "failed"
    target = f"{tmp_dir}/bronze"
    tables.write_table(df, target, "WRITE_TRUNCATE", partition_by="ano_mes")
    before = spark.read.parquet(target).count()
    one = df.where(F.col("ano_mes") == "2024-02")
    for _ in range(2):   # re-loading a period twice changes nothing
        tables.write_table(one, target, "WRITE_TRUNCATE", partition_by="ano_mes", replace_partitions=True)
    assert spark.read.parquet(target).count() == before
    tables.write_table(one, target, "WRITE_APPEND", partition_by="ano_mes")
    assert spark.read.parquet(target).count() == before + one.count()
    tables.create_table_if_absent(spark, "t_fixture_bronze", df.schema, f"{tmp_dir}/created", "ano_mes")
    tables.create_table_if_absent(spark, "t_fixture_bronze", df.schema, f"{tmp_dir}/created", "ano_mes")
    assert spark.table("t_fixture_bronze").count() == 0


def test_debts_multi_year_with_missing_folder(spark, tmp_dir):
    header = ("cpf_cnpj;tipo_pessoa;tipo_devedor;nome_devedor;uf_devedor;unidade_responsavel;numero_inscricao;"
              "tipo_situacao_inscricao;situacao_inscricao;receita_principal;data_inscricao;indicador_ajuizado;"
              "valor_consolidado")
    for year, q in [(2023, 1), (2023, 2), (2024, 1)]:
        _write(f"{tmp_dir}/debts/{year}/{q}trimestre/FGTS/arquivo.csv",
               header + f"\n11.111.111/0001-91;PJ;PRINCIPAL;ACME;SP;X;{year}{q};A;B;C;01/02/{year};SIM;10,5\n",
               "UTF-8")
    df = landed.read_debts(spark, f"{tmp_dir}/debts", "FGTS", years=[2022, 2023, 2024])
    got = sorted((r.ano, r.trimestre, r.tipo) for r in df.collect())
    assert got == [(2023, 1, "FGTS"), (2023, 2, "FGTS"), (2024, 1, "FGTS")]


def test_panel_csv_index_column_and_leading_zeros(spark, tmp_dir):
    _write(f"{tmp_dir}/panel.csv",
           "Unnamed: 0,cnpj,ano_mes,situacao_cadastral,cnae_fiscal_principal,uf,capital_social\n"
           "0,00012345000191,2024-01,2,0111301,['SP'],10.5\n1,00012345000191,2024-02,,0111301,SP,nan\n")
    df = landed.read_panel_csv(spark, f"{tmp_dir}/panel.csv")
    rows = df.orderBy("ano_mes").collect()
    assert "Unnamed: 0" not in df.columns and len(df.columns) == 19
    assert rows[0].cnpj == "00012345000191" and rows[0].cnae_fiscal_principal == "0111301"
    assert rows[1].situacao_cadastral is None and rows[1].natureza_juridica is None
    curated = panel.curate_panel(df).orderBy("ano_mes").collect()
    assert [r.uf for r in curated] == ["SP", "SP"] and str(curated[0].ano_mes) == "2024-01-01"


def test_tax_regime_folders(spark, tmp_dir):
    head = "ano;cnpj;cnpj_da_scp;forma_de_tributacao;quantidade_de_escrituracoes\n"
    _write(f"{tmp_dir}/regimes/lucro_presumido/a.csv", head + "2023;11.111.111/0001-91;0;LUCRO PRESUMIDO;1\n")
    _write(f"{tmp_dir}/regimes/lucro_real/b.csv", head + "2023;11.111.111/0001-91;0;LUCRO REAL;2\n")
    rows = landed.read_tax_regime(spark, f"{tmp_dir}/regimes").collect()
    got = sorted((r.regime, r.quantidade_de_escrituracoes) for r in rows)
    assert got == [("lucro_presumido", 1), ("lucro_real", 2)]


def test_json_series_monthly_means_and_fill(spark, tmp_dir):
    _write(f"{tmp_dir}/series/selic_meta_mensal.json",
           json.dumps([{"data": "01/01/2020", "valor": "4.50"}, {"data": "01/02/2020", "valor": "4.25"}]))
    _write(f"{tmp_dir}/series/cambio_dolar_media_mensal.json",
           json.dumps([{"data": "02/01/2020", "valor": "4.0"}, {"data": "03/01/2020", "valor": "5.0"},
                       {"data": "03/02/2020", "valor": "x"}, {"data": "01/03/2020", "valor": "6.0"}]))
    _write(f"{tmp_dir}/series/icei.json", "[]")
    long = series.read_series(spark, f"{tmp_dir}/series/*.json")
    assert long.where("serie = 'icei'").count() == 0
    means = macro.series_means(long, "serie", "data", "valor")
    wide = macro.wide(means, ["selic_meta_mensal", "cambio_dolar_media_mensal"])
    got = {r.ano_mes: r for r in wide.collect()}
    assert got["2020-01"].cambio_dolar_media_mensal == 4.5
    assert got["2020-02"].cambio_dolar_media_mensal is None          # only an unparsable value
    assert got["2020-03"].selic_meta_mensal is None                   # month missing from one series
    silver = {r.ano_mes: r for r in macro.silver(wide).collect()}
    assert silver["2020-03"].selic_meta_mensal == 4.375 and silver["2020-02"].cambio_dolar_media_mensal == 5.25
    out = tables.write_bronze_silver(wide, f"{tmp_dir}/bronze", f"{tmp_dir}/silver")
    assert out.count() == 3


def test_messages_decode_and_validate(spark):
    def b64(s):
        return base64.b64encode(s.encode()).decode()
    rows = [("1", b64("{}")), ("2", b64('{"period":"2024-03"}')),
            ("3", b64('{"period":"2024-03","data_type":"empresas","mode":"WRITE_TRUNCATE"}')),
            ("4", b64('{"data_type":"socios"}')), ("5", b64("{not json")), ("6", "%%%")]
    df = spark.createDataFrame(rows, "id string, data string").withColumn("m", decode_message("data"))
    got = {r.id: r for r in df.select("id", "m.*", message_status(F.col("m")).alias("status")).collect()}
    assert got["1"].status == "ok" and got["1"].period is None and got["1"].mode == "WRITE_APPEND"
    assert got["2"].period == "2024-03" and got["2"].data_type is None
    assert got["3"].data_type == "empresas" and got["3"].mode == "WRITE_TRUNCATE"
    assert got["4"].status == "bad_data_type"
    assert got["5"].status == "bad_message" and got["6"].status == "bad_message"


def _zip_bytes(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("pasta/", b"")
        for name, text in members.items():
            zf.writestr(name, text.encode("ISO-8859-1"))
    return buf.getvalue()


def test_archives_good_and_truncated(spark, tmp_dir):
    good = _zip_bytes({"pasta/A.EMPRECSV": "l1\nl2\n", "B.EMPRECSV": "x\n"})
    os.makedirs(f"{tmp_dir}/zips", exist_ok=True)
    with open(f"{tmp_dir}/zips/good.zip", "wb") as fh:
        fh.write(good)
    with open(f"{tmp_dir}/zips/bad.zip", "wb") as fh:
        fh.write(good[: len(good) // 2])
    out = archives.read_archives(spark, f"{tmp_dir}/zips", base_names=True).collect()
    ok = sorted((r.member, r.line) for r in out if r.ok)
    assert ok == [("A.EMPRECSV", "l1"), ("A.EMPRECSV", "l2"), ("B.EMPRECSV", "x")]
    bad = [r for r in out if not r.ok]
    assert len(bad) == 1 and bad[0].archive.endswith("bad.zip") and bad[0].error


def test_incremental_ingest_once(spark, tmp_dir):
    root = f"{tmp_dir}/landing"
    _establishments(root)
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    first = incremental.ingest_available(incremental.registry_stream(spark, root, "estabelecimentos"), out, ckpt)
    second = incremental.ingest_available(incremental.registry_stream(spark, root, "estabelecimentos"), out, ckpt)
    assert first == 5 and second == 0
    assert spark.read.parquet(out).count() == 5
    _write(f"{root}/2024-03/new.ESTABELE", EST_ROW.format(b="00055555", dv="00", name="N", sit="02", cnae="1") + "\n")
    third = incremental.ingest_available(incremental.registry_stream(spark, root, "estabelecimentos"), out, ckpt)
    assert third == 1 and spark.read.parquet(out).count() == 6


def test_triggered_loads(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    _establishments(f"{landing}/estabelecimentos")
    for p in ("2024-01", "2024-02"):
        _write(f"{landing}/empresas/{p}/x.csv", '"00012345";"ACME";"2062";"49";"1000,00";"01";""\n')
    msgs = [{"id": "a", "data": base64.b64encode(b'{"data_type":"empresas"}').decode()},
            {"id": "b", "data": base64.b64encode(b'{"period":"2024-02","data_type":"empresas",'
                                                  b'"mode":"WRITE_TRUNCATE"}').decode()},
            {"id": "c", "data": base64.b64encode(b'{"data_type":"socios"}').decode()}]
    _write(f"{tmp_dir}/inbox/m.json", "\n".join(json.dumps(m) for m in msgs) + "\n", "UTF-8")
    status = triggered.run_triggered_loads(spark, f"{tmp_dir}/inbox", landing, f"{tmp_dir}/tables",
                                           f"{tmp_dir}/status", f"{tmp_dir}/ckpt")
    got = {r.id: r for r in status.collect()}
    assert got["a"].status == "ok" and got["c"].status == "bad_data_type"
    assert got["a"].rows == 2 and got["b"].rows == 1                     # the rows each asked for
    assert triggered.current(spark, f"{tmp_dir}/tables", "empresas").count() == 2   # loaded once


def _messages(spark, *bodies):
    rows = [(f"m{k}", base64.b64encode(b.encode()).decode()) for k, b in enumerate(bodies)]
    decoded = spark.createDataFrame(rows, "id string, data string").withColumn("m", decode_message("data"))
    return decoded.select("id", "m.*", message_status(F.col("m")).alias("status"))


def _companies(landing, *periods):
    for p in periods:
        _write(f"{landing}/empresas/{p}/x.csv", '"00012345";"ACME";"2062";"49";"1000,00";"01";""\n')


def test_triggered_batch_retry_after_a_crash_adds_nothing(spark, tmp_dir, monkeypatch):
    _companies(f"{tmp_dir}/landing", "2024-01", "2024-02")
    batch = _messages(spark, '{"data_type":"empresas","mode":"WRITE_APPEND"}', '{"data_type":"all","period":"2024-02"}')
    handler = triggered.handle_batch(f"{tmp_dir}/landing", f"{tmp_dir}/tables", f"{tmp_dir}/status")
    write = triggered.write_table

    def crash(df, path, **kw):
        if path.endswith("status"):
            raise OSError("lost")
        write(df, path, **kw)
    _establishments(f"{tmp_dir}/landing/estabelecimentos")
    monkeypatch.setattr(triggered, "write_table", crash)
    with pytest.raises(OSError):
        handler(batch, 7)
    monkeypatch.setattr(triggered, "write_table", write)
    handler(batch, 7)
    handler(batch, 7)
    got = {r.id: r.rows for r in spark.read.parquet(f"{tmp_dir}/status").collect()}
    assert got["m0"] == 2
    assert triggered.current(spark, f"{tmp_dir}/tables", "empresas").count() == 2


def test_a_replacing_load_drops_what_came_before(spark, tmp_dir):
    _companies(f"{tmp_dir}/landing", "2024-01", "2024-02")
    _establishments(f"{tmp_dir}/landing/estabelecimentos")
    handler = triggered.handle_batch(f"{tmp_dir}/landing", f"{tmp_dir}/tables", f"{tmp_dir}/status")
    append, replace = '{"data_type":"empresas"}', '{"data_type":"empresas","period":"2024-02","mode":"WRITE_TRUNCATE"}'

    def periods():
        rows = triggered.current(spark, f"{tmp_dir}/tables", "empresas").groupBy("ano_mes").count().collect()
        return {r["ano_mes"]: r["count"] for r in rows}
    for batch_id, (body, want) in enumerate([(append, (1, 1)), (append, (2, 2)), (replace, (2, 1)), (append, (3, 2))]):
        handler(_messages(spark, body), batch_id)
        assert periods() == dict(zip(("2024-01", "2024-02"), want, strict=True))


def test_truncate_does_not_depend_on_the_session(spark, tmp_dir):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "p string, n int")
    for mode in ("static", "dynamic"):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        tables.write_table(rows, f"{tmp_dir}/{mode}", partition_by="p")
        tables.write_table(rows.where("p = 'b'"), f"{tmp_dir}/{mode}", partition_by="p", replace_partitions=True)
        assert spark.read.parquet(f"{tmp_dir}/{mode}").count() == 2
        tables.write_table(rows.where("p = 'b'"), f"{tmp_dir}/{mode}", partition_by="p")
        assert spark.read.parquet(f"{tmp_dir}/{mode}").count() == 1   # the stale partition is gone
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_a_load_over_its_budget_is_rejected(spark, tmp_dir):
    rows = spark.createDataFrame([("1", 1), (None, 2), (None, 3)], "k string, n int")
    bad = F.col("k").isNull()
    with pytest.raises(tables.LoadRejected):
        tables.load_with_rejects(rows, bad, f"{tmp_dir}/t", f"{tmp_dir}/r", 1)
    assert not os.path.exists(f"{tmp_dir}/t") and spark.read.parquet(f"{tmp_dir}/r").count() == 2
    assert tables.load_with_rejects(rows, bad, f"{tmp_dir}/t", f"{tmp_dir}/r", 2) == {"rows": 1, "bad_rows": 2}
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 1


def test_all_is_a_data_type(spark):
    got = {r.id: r.status for r in _messages(spark, '{"data_type":"all"}', '{"data_type":"ALL"}', '{"data_type":"x"}').collect()}
    assert got == {"m0": "ok", "m1": "ok", "m2": "bad_data_type"}


def test_debts_count_from_months_without_a_panel_row(spark):
    from tessera.operators import panel as pn
    p = spark.createDataFrame([("1", "2020-02-01"), ("1", "2020-05-01"), ("2", "2020-05-01")],
                              "cnpj string, d string").select("cnpj", F.to_date("d").alias("ano_mes"))
    debts = spark.createDataFrame([("1/", 2019, 4, "FGTS", "100", "SIM"), ("1", 2020, 1, "FGTS", "50,5", "NAO"),
                                   ("1", 2020, 1, "Previdenciario", "7", "SIM"), ("1", 2021, 1, "FGTS", "9", "SIM"),
                                   ("", 2019, 1, "FGTS", "9", "SIM"), ("1", 2019, 1, "Outro", "9", "SIM")],
                                  "cpf_cnpj string, ano int, trimestre int, tipo string, valor_consolidado string, "
                                  "indicador_ajuizado string")
    out = pn.accumulate_debts(p, pn.debt_movements(debts)).orderBy("cnpj", "ano_mes").collect()
    assert [r.pgfn_fgts_valor_acumulado_t_minus_1 for r in out] == [100.0, 150.5, 0.0]
    assert [r.pgfn_prev_valor_acumulado_t_minus_1 for r in out] == [0.0, 7.0, 0.0]
    assert [r.pgfn_fgts_ajuizados_t_minus_1 for r in out] == [1.0, 1.0, 0.0]


def test_path_patterns_are_matched_by_file_not_by_row(spark, tmp_dir):
    for month in ("2024-01", "2024-02"):
        os.makedirs(f"{tmp_dir}/r/{month}")
        with open(f"{tmp_dir}/r/{month}/a b.EMPRECSV", "w", encoding="latin-1") as f:
            f.write("00000001;RAZAO;2062;49;1,00;01;\n" * 3)
    os.makedirs(f"{tmp_dir}/d/ano=2024/trimestre=2trimestre/tipo=FGTS")
    with open(f"{tmp_dir}/d/ano=2024/trimestre=2trimestre/tipo=FGTS/x.csv", "w", encoding="utf-8") as f:
        f.write("header\n1;PJ\n2;PJ\n")
    rows = landed.read_registry(spark, f"{tmp_dir}/r", "empresas")
    debts = landed.read_debts(spark, f"{tmp_dir}/d", "FGTS")
    assert rows.columns[-1] == "ano_mes" and debts.columns[-3:] == ["ano", "trimestre", "tipo"]
    assert sorted(r["ano_mes"] for r in rows.collect()) == ["2024-01"] * 3 + ["2024-02"] * 3
    assert [(r["ano"], r["trimestre"]) for r in debts.collect()] == [(2024, 2)] * 2
    for df in (rows, debts):
        of_rows, of_files = df._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow", 1)
        assert "regexp_extract" not in of_rows and "regexp_extract" in of_files


def test_dirty_lines_make_few_files(spark, tmp_dir, monkeypatch):
    rows = spark.range(0, 37 * 400, 1, 12).selectExpr(
        "id as cnpj", "add_months(date'1998-01-01', cast(id % 3 as int)) as ano_mes", "2 as situacao_cadastral",
        "'A' as cnae_fiscal_principal", "'SP' as uf")
    monkeypatch.setattr(rows_only, "panel", lambda *_: rows)
    root = f"{rows_only._establishments(spark, tmp_dir)}/estabelecimentos"
    months = [d for d in os.listdir(root) if "=" in d]
    dirty = [f for d in months for f in os.listdir(f"{root}/{d}") if f.endswith(".txt")]
    assert len(months) == 3 and len(dirty) == 3
    assert sum(1 for d in months for f in os.listdir(f"{root}/{d}") if f.endswith(".txt")
               for _ in open(f"{root}/{d}/{f}")) == 3 * 400
