"""Event files, metadata and configuration."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gatefold.sources import events, fcs, fcs_source, metadata


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    p = tmp_path_factory.mktemp("fcs")
    rng = np.random.default_rng(1)
    ch = [("FSC-A", ""), ("FSC-H", ""), ("SSC-A", ""), ("BL1-A", "CD3 : FITC"), ("BL1-H", "CD3 : FITC"), ("BL2-A", "CD4"), ("Time", "")]
    for k, (kind, big) in enumerate((("F", False), ("D", True), ("I", False))):
        x = rng.integers(0, 1000, (40 + k, len(ch))).astype(float)
        (p / f"A{k + 1}_run.fcs").write_bytes(fcs.write(ch, x, {"$DATE": f"0{k + 1}-JAN-2024"}, kind, big))
    (p / "Compensation_control.fcs").write_bytes(fcs.write(ch, x))
    (p / "notes.txt").write_text("x")
    return str(p)


@pytest.mark.parametrize("kind", ["F", "D", "I"])
@pytest.mark.parametrize("big", [False, True])
def test_fcs_round_trip(kind, big):
    x = np.random.default_rng(2).integers(0, 5000, (33, 3)).astype(float)
    kw, y = fcs.parse(fcs.write([("a", ""), ("b", "x|y"), ("c", "")], x, {"$CUSTOM": "v|w"}, kind, big))
    assert (x == y).all() and kw["$P2S"] == "x|y" and kw["$CUSTOM"] == "v|w" and kw["$TOT"] == "33"


def test_fcs_offsets_in_the_text_segment():
    d = fcs.write([("a", "")], np.arange(5.0)[:, None])
    blank = d[:26] + b"       0       0" + d[42:]
    assert fcs.parse(blank)[1].ravel().tolist() == [0, 1, 2, 3, 4]
    with pytest.raises(fcs.FcsError):
        fcs.parse(b"nonsense")


def test_non_finite_values_become_zero():
    assert fcs.parse(fcs.write([("a", "")], np.array([[np.nan], [np.inf], [2.0]])))[1].ravel().tolist() == [0, 0, 2]


def test_channels_and_spill():
    kw = {"$PAR": "4", "$P1N": "FSC-A", "$P2N": "BL1-A", "$P2S": "CD3 : F", "$P3N": "BL1-H", "$P3S": "CD3 : F", "$P4N": "BL9-A", "$P4S": "CD3"}
    assert [(c["symbol"], c["role"]) for c in fcs.channels_of(kw)] == [("FSC-A", "scatter"), ("CD3", "marker"), ("CD3", "other"), ("CD3", "other")]
    assert fcs.spill_matrix({"$SPILLOVER": "2,a,b,1,0.1,0,1"}) == (["a", "b"], [[1.0, 0.1], [0.0, 1.0]])
    assert fcs.spill_matrix({}) is None and fcs.spill_matrix({"SPILL": "2,a,b,1"}) is None


def test_scan_prunes_and_caps(spark, folder):
    df = fcs.scan(spark, folder, ["CD3", "CD4", "CD9"], max_events=10)
    assert df.columns == ["file", "event_index", "FSC-A", "FSC-H", "SSC-A", "CD3", "CD4", "CD9"]
    assert df.filter("CD9 is not null").count() == 0 and df.groupBy("file").count().agg(F.max("count")).first()[0] == 10
    h = fcs.headers(spark, folder).withColumn("sample_id", events.sample_id(F.col("file"), F.col("keywords")))
    assert {r.sample_id for r in h.collect()} == {"A1", "A2", "A3", "Compensation_control"}
    assert events.date_batches(h).count() == 4
    assert events.event_files(spark, folder).count() == 3


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    x = np.random.default_rng(3).integers(0, 5000, (1003, 3)).astype(float)
    (tmp_path / "one.fcs").write_bytes(fcs.write([("FSC-A", ""), ("BL1-A", "CD3"), ("BL2-A", "CD4")], x))
    path = [f"file://{tmp_path}/one.fcs"]
    whole = fcs.open_scan(spark, path, ["CD4"], (), events_per_task=100)
    assert whole.rdd.getNumPartitions() == 11 and whole.columns == ["file", "event_index", "CD4"]
    assert [(r.event_index, r.CD4) for r in whole.orderBy("event_index").collect()] == [(i + 1, v) for i, v in enumerate(x[:, 2].tolist())]
    some = fcs.open_scan(spark, path, ["CD4"], (), max_events=50, events_per_task=100)
    assert sorted(r.event_index for r in some.collect()) == (fcs.systematic(1003, 50) + 1).tolist()
    (tmp_path / "none.fcs").write_bytes(fcs.write([("BL1-A", "CD3")], np.zeros((0, 1))))
    assert fcs.open_scan(spark, [f"{tmp_path}/none.fcs"], ["CD3"], ()).count() == 0


def test_export_streams_samples_groups_and_all(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(f"S {s}", i, "ab"[s % 2] if s < 3 else None, float(np.float32(rng.normal())), None if i == 5 else float(i)) for s in range(4) for i in range(200)]
    df = spark.createDataFrame(rows, "sample_id string, event_index long, group string, x double, y double").orderBy(F.rand(2))
    fcs_source.export_files(df, f"{tmp_path}/out", ["x", "y"], ["sample_id", "group", None])
    names = sorted(f.name for f in (tmp_path / "out").iterdir())
    assert names == ["all.fcs", "group_a.fcs", "group_b.fcs", "group_unassigned.fcs", *[f"sample_id_S_{s}.fcs" for s in range(4)]]
    kw, y = fcs.parse((tmp_path / "out/sample_id_S_1.fcs").read_bytes())
    want = np.array([[r[3], r[4] or 0.0] for r in rows if r[0] == "S 1"])
    assert (y == want).all() and kw["$TOT"] == "200" and int(kw["$P2R"]) >= 199
    every = fcs.parse((tmp_path / "out/all.fcs").read_bytes())[1]
    assert (every == np.array([[r[3], r[4] or 0.0] for r in rows])).all()
    assert len(fcs.parse((tmp_path / "out/group_a.fcs").read_bytes())[1]) == 400


def test_failed_exports_leave_nothing(spark, tmp_path):
    df = spark.createDataFrame([("A", 1, 1.0), ("A", 2, 2.0)], "sample_id string, event_index long, x double")
    bad = df.withColumn("x", F.when(F.col("event_index") == 2, F.raise_error(F.lit("broken")).cast("double")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="broken"):
        fcs_source.export_files(bad, f"{tmp_path}/out", ["x"])
    assert not [f for f in (tmp_path / "out").glob("*.fcs")]


def test_panels(spark):
    d = spark.createDataFrame([("s2", "b", 1), ("s1", "a", 2), ("s2", "a", 3), ("s3", "a", 4), ("s3", "b", 4)], "sample_id string, symbol string, seen long")
    got = {r.sample_id: (r.marker_set, r.panel_i) for r in events.fingerprint_panels(d, "seen").collect()}
    assert got == {"s2": ("a|b", 1), "s3": ("a|b", 1), "s1": ("a", 2)}


def test_export_codes(spark):
    df, legend = fcs.category_codes(spark.createDataFrame([("b",), (None,), ("a",)], "g string"), "g", "code")
    assert {(r.level, r.code) for r in legend.collect()} == {("a", 1), ("b", 2), ("unassigned", 3)} and df.count() == 3


def test_patient_table(spark, tmp_path):
    (tmp_path / "p.csv").write_text("Patient;Group;Gender;Height;DOB;Secret\nP1;HC;m;0;13/02/2000;x\np2;S1;F;170,5;01/12/1990;y\n;;;;;\n")
    d = metadata.load_patients(spark, f"{tmp_path}/p.csv", dt.date(2020, 3, 1))
    got = {r.patient_id: r for r in d.collect()}
    assert set(d.columns) == {"patient_id", "cohort", "sex", "height_cm", "date_of_birth", "age_years"}
    assert got["P1"].sex == "male" and got["P1"].height_cm is None and got["P1"].age_years == 20
    assert got["p2"].height_cm == 170.5 and got["p2"].date_of_birth == dt.date(1990, 12, 1)
    assert {r.column: r.n_present for r in metadata.completeness(d).collect()}["height_cm"] == 1


@pytest.mark.parametrize(("raw", "want"), [("Lunge", "lung"), ("lunge?", "lung (uncertain)"), ("Lunge / Haut", "lung / skin"), ("Haut und Knie?", "skin / knee (uncertain)"), ("Haut, Zeh", "skin / Zeh"), ("Zeh", "Zeh"), (None, None)])
def test_value_translation(spark, raw, want):
    d = spark.createDataFrame([(raw,)], "v string")
    assert d.select(metadata.translate("v", metadata.VALUES["infection_focus"]).alias("t")).first().t == want


def test_default_spec_is_well_formed():
    from gatefold.operators import populations
    from gatefold.sources import defaults

    assert len(defaults.POPULATIONS) == 15 and len(populations.positive_markers(defaults.POPULATIONS)) == sum(d != "below" for s in defaults.POPULATIONS.values() for d in s.values())
    assert populations.block_populations(defaults.FUNCTIONAL_BLOCKS["monocyte"], defaults.POPULATIONS, list(defaults.POPULATIONS)) == defaults.MONOCYTES


@pytest.mark.parametrize(("raw", "want"), [(["03/04/2001", "13/04/2001"], dt.date(2001, 4, 3)), (["03/04/2001", "04/13/2001"], dt.date(2001, 3, 4)), (["03/04/31"], dt.date(1931, 4, 3)), (["2001-04-03"], dt.date(2001, 4, 3)), (["3 Apr 2001"], dt.date(2001, 4, 3)), (["soon"], None)])
def test_date_order(spark, raw, want):
    d = metadata.parse_dates(spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, d string"), "d", dt.date(2025, 1, 1))
    assert d.filter("i = 0").first().d == want


def test_sample_map(spark, tmp_path):
    files = spark.createDataFrame([("a.fcs",), ("b.fcs",)], "file string")
    (tmp_path / "ok.csv").write_text("file,sample_id,is_control\na.fcs,A,yes\nb.fcs,B,0\n")
    m = {r.file: r.is_control for r in metadata.load_sample_map(spark, f"{tmp_path}/ok.csv", files).collect()}
    assert m == {"a.fcs": True, "b.fcs": False}
    for name, text in (("twice", "file,sample_id\na.fcs,A\na.fcs,B\n"), ("gone", "file,sample_id\na.fcs,A\n"), ("head", "name\nx\n")):
        (tmp_path / f"{name}.csv").write_text(text)
        with pytest.raises(metadata.SampleMapError):
            metadata.load_sample_map(spark, f"{tmp_path}/{name}.csv", files)
    assert metadata.sample_map_template(files).first().sample_id == "a"


def test_counts_match_by_patient_then_by_file(spark):
    smap = spark.createDataFrame([("x_P1.fcs", "A", "P1"), ("run P22.fcs", "B", "Q"), ("zP3.fcs", "C", "R"), ("u_P4.fcs", "D", "S"), ("v-P4.fcs", "E", "T")], "file string, sample_id string, patient_id string")
    c = spark.createDataFrame([(k, "T", 1.0) for k in ("p1 ", "P22", "P3", "P4", "nobody")], "sample_key string, population string, cells_per_ul double")
    assert {r.sample_id for r in metadata.match_counts(c, smap).collect()} == {"A", "B"}


def test_labels(spark, tmp_path):
    (tmp_path / "l.csv").write_text("Sample,Event,Cluster\nS1,3,x\n")
    r = metadata.read_labels(spark, f"{tmp_path}/l.csv").first()
    assert (r.sample_id, r.event_index, r.external_label) == ("S1", 3, "x")
    (tmp_path / "m.csv").write_text("a,b,c\nS1,3,x\n")
    assert metadata.read_labels(spark, f"{tmp_path}/m.csv", sample_id="a", event_index="b", external_label="c").count() == 1
    with pytest.raises(ValueError):
        metadata.read_labels(spark, f"{tmp_path}/m.csv")


def test_config_round_trip(tmp_path):
    c = metadata.RunConfig(populations={"T": {"CD3": "above", "any_of": {"CD4": "above"}}}, ratios={"r": ("T", "B")}, covariates=("age",))
    c.save(tmp_path / "c.yaml", [{"marker": "CD3", "threshold": 1.5, "source": "valley", "needs_review": False}, {"marker": "CD3", "threshold": 9, "source": "valley", "needs_review": False}])
    d = metadata.RunConfig.load(tmp_path / "c.yaml")
    assert d.populations == c.populations and d.ratios == {"r": ("T", "B")} and d.threshold_rows() == [("CD3", 1.5)]


def workbook(path, rows):
    """A minimal workbook: shared strings for text, plain cells for numbers."""
    import zipfile

    shared: list[str] = []
    body = ""
    for i, row in enumerate(rows, 1):
        body += f'<row r="{i}">'
        for k, v in enumerate(row):
            ref = f"{'ABCDEF'[k]}{i}"
            if isinstance(v, str):
                shared.append(v)
                body += f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>'
            elif v is not None:
                body += f'<c r="{ref}"><v>{v}</v></c>'
        body += "</row>"
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")


def test_counts_of_a_workbook(spark, tmp_path):
    from gatefold.sources import metadata

    workbook(tmp_path / "c.xlsx", [["sample", "in 1 mL blood", "T", "B"], ["S1", None, 1200, "250,0"], ["", None, None, None], ["S2", None, 900, None]])
    got = sorted((r.sample_key, r.population, r.cells_per_ul) for r in metadata.read_counts(spark, f"file://{tmp_path}/c.xlsx").collect())
    assert got == [("S1", "B", 0.25), ("S1", "T", 1.2), ("S2", "T", 0.9)]


def test_encoding_is_found(spark, tmp_path):
    from gatefold.sources import metadata

    for name, code in (("a", "utf-8"), ("b", "latin1")):
        (tmp_path / f"{name}.csv").write_bytes("id;Ort\n1;Köln\n".encode(code))
        assert metadata.read_table(spark, f"file://{tmp_path}/{name}.csv").first().Ort == "Köln"


def test_batches_come_from_the_first_table_that_has_them(spark):
    from gatefold.sources import metadata

    smap = spark.createDataFrame([("s1", " p1 ", "x"), ("s2", "P2", "y"), ("s3", None, "x")], "sample_id string, patient_id string, plate string")
    patients = spark.createDataFrame([("P1", "HC", "m"), ("p2", "", "n")], "patient_id string, cohort string, site string")
    rows = lambda d: sorted(map(tuple, d.collect()))
    assert rows(metadata.batch_of("plate", smap, patients)) == [("s1", "x"), ("s2", "y"), ("s3", "x")]
    assert rows(metadata.batch_of("site", smap, patients)) == [("s1", "m"), ("s2", "n")]
    assert rows(metadata.group_of(smap, patients, "cohort")) == [("s1", "HC")]
    kw = spark.createDataFrame([("s1", {"$DATE": "1"}), ("s2", {"$DATE": "2"})], "sample_id string, keywords map<string,string>")
    assert rows(metadata.batch_of("none", smap, patients, kw)) == [("s1", "1"), ("s2", "2")] and metadata.batch_of("none", smap, patients) is None
