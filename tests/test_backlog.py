"""Flows read in rounds: killed at every point, gone on with, written once, committed once."""

import json

import pytest

from acopio.plans import backlog, flow
from acopio.plans.backlog import Ledger, ledger_path
from acopio.plans.flow import run_flow
from acopio.sources import readers
from tests.test_writing import history, rows, spec, stock

OPTIONS = {
    "relative_upload_file_path": "ventas", "relative_upload_control_path": "control",
    "checkpoint_prefix": "control/leidos", "readiness_wait_seconds": 0,
}


class Killed(BaseException):
    pass


class Place:
    def __init__(self, spark, root, target=None):
        self.spark, self.src, self.lake, self.out = spark, root / "src", root / "lake", root / "out"
        self.src.mkdir(), self.lake.mkdir()
        self.specs = spec(spark, target or {**history(self.out, ""), "p_expresion_campos_extras": "concat('p', k % 3) AS periodo", "p_condicion_reproceso": None})
        self.checkpoint = f"{self.lake}/control/leidos"
        self.ledger = Ledger(spark, ledger_path(self.checkpoint))

    def put(self, *days, text=None):
        for d in days:
            (self.src / f"v_202401{d:02}.csv").write_text(text or f"k,v\n{d},x{d}\n")

    def run(self, header="true", **kw):
        frame = self.spark.createDataFrame
        land = frame([(str(self.src), str(self.lake), "v.csv", "2024-01-01", "2024-01-31")], "source_uri string, landing_uri string, NOMBRE_ARCHIVO string, FECHA_DESDE string, FECHA_HASTA string")
        disc = frame([(str(self.lake), str(self.lake))], "BUCKET_BLOB string, BUCKET_RAW string")
        read = frame([(str(self.lake), json.dumps({"csv": {"header": header}}))], "BUCKET_BLOB string, READER_OPTIONS string")
        return run_flow(self.spark, land, disc, read, self.specs, OPTIONS, files_per_round=3, **kw)

    def table(self, *columns):
        return rows(self.spark.read.parquet(f"{self.out}/t"), *columns)

    def recorded(self):
        return sorted(r.path.rsplit("_", 1)[1] for r in self.spark.read.parquet(self.checkpoint).collect())


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path)


def expected(*days):
    return sorted(((str(d), f"x{d}") for d in days), key=str)


def rounds_read(monkeypatch):
    """Counts the rounds read; dies before the one whose number is set."""
    state = {"read": 0, "die": None}
    real = readers.read_files

    def counted(*args, **kw):
        if state["read"] == state["die"]:
            raise Killed
        state["read"] += 1
        return real(*args, **kw)

    monkeypatch.setattr(backlog, "read_files", counted)
    return state


def test_rounds_write_once_and_commit_all(place, monkeypatch):
    state = rounds_read(monkeypatch)
    place.put(*range(1, 11))
    run = place.run()
    assert run.audit.count() == 1 and run.audit.first().cantidad_insertados == 10
    assert state["read"] == 4 and place.table("k", "v") == expected(*range(1, 11))
    assert place.recorded() == [f"202401{d:02}.csv" for d in range(1, 11)]
    closed = place.ledger.closed().collect()
    assert [(r["rounds"], r["files"]) for r in closed] == [(4, 10)] and place.ledger.runs() == []
    place.put(11)
    assert place.run().audit.first().cantidad_insertados == 1
    assert place.run().status.first().estado == "FALLIDO" and state["read"] == 5


@pytest.mark.parametrize("die", [1, 3])
def test_a_killed_run_goes_on_after_its_last_round(place, monkeypatch, die):
    state = rounds_read(monkeypatch)
    state["die"] = die
    place.put(*range(1, 11))
    with pytest.raises(Killed):
        place.run()
    (run,) = place.ledger.runs()
    assert len(place.ledger.rounds(run)) == die
    state["die"] = None
    place.put(12)
    place.run()
    assert place.table("k", "v") == expected(*range(1, 11), 12)
    assert len(place.recorded()) == len(set(place.recorded())) == 11
    assert len(place.ledger.closed().collect()) == 1 and place.ledger.runs() == []
    done = place.ledger.closed().first()
    assert done["files"] == 11 and done["rounds"] >= max(die, 4)


def test_half_a_round_is_read_again(place, monkeypatch):
    real = Ledger.note
    place.put(*range(1, 8))

    def dying(self, run, state, *args, **kw):
        if state == backlog.READ and args[0] == 1:
            raise Killed
        return real(self, run, state, *args, **kw)

    with monkeypatch.context() as m, pytest.raises(Killed):
        m.setattr(Ledger, "note", dying)
        place.run()
    place.run()
    assert place.table("k", "v") == expected(*range(1, 8))


@pytest.mark.parametrize("point", ["after writing", "before the commit", "before the end"])
def test_killed_around_the_write(spark, tmp_path, monkeypatch, point):
    place = Place(spark, tmp_path, stock(tmp_path / "out", "2024-01"))
    state = rounds_read(monkeypatch)
    written = []
    real = flow.write_tables
    monkeypatch.setattr(flow, "write_tables", lambda *a: (written.append("k" in a[1].columns), real(*a))[1])
    place.put(*range(1, 8))

    def die(*_, **__):
        raise Killed

    with monkeypatch.context() as m, pytest.raises(Killed):
        if point == "after writing":
            m.setattr(backlog.Backlog, "written", die)
        elif point == "before the commit":
            m.setattr(backlog, "commit", die)
        else:
            m.setattr(Ledger, "close", die)
        place.run()
    read = state["read"]
    place.run()
    assert place.table("k", "v") == expected(*range(1, 8)) and state["read"] == read
    assert sorted(set(place.recorded())) == [f"202401{d:02}.csv" for d in range(1, 8)]
    assert sum(written) == (2 if point == "after writing" else 1)
    assert place.ledger.closed().count() == 1 and place.ledger.runs() == []
    assert spark.read.parquet(f"{place.out}/t_sdelta").count() == 7


def test_a_failed_write_is_begun_anew(place, spark, monkeypatch):
    state = rounds_read(monkeypatch)
    place.put(*range(1, 5))
    good, place.specs = place.specs, spec(spark, history(place.out, "x", tipo_escritura="orc"))
    assert place.run().status.first().estado == "FALLIDO"
    assert place.ledger.runs() == [] and state["read"] == 2
    place.specs = good
    place.run()
    assert state["read"] == 4 and place.table("k", "v") == expected(*range(1, 5))


def test_other_reader_options_read_again(place, monkeypatch):
    state = rounds_read(monkeypatch)
    place.put(*range(1, 8))
    state["die"] = 2
    with pytest.raises(Killed):
        place.run(header="false")
    state.update(die=None, read=0)
    place.run()
    assert state["read"] == 3 and place.table("k", "v") == expected(*range(1, 8))
    assert place.ledger.closed().count() == 1


def test_errors_and_files_of_rounds(spark, tmp_path):
    for i in range(7):
        (tmp_path / f"v_{i}.csv").write_text(f"k\n{i}\n")
    (tmp_path / "bad.parquet").write_bytes(b"PAR1")
    (tmp_path / "odd.json").write_text('{"k": "j"}\n')
    found = [(f"{tmp_path}/{n}", None, None, None) for n in [f"v_{i}.csv" for i in range(7)] + ["bad.parquet", "odd.json", "gone.csv"]]
    found += [("", "ERROR_CARGA", "lost", "up.csv")]
    manifest = spark.createDataFrame(found, "path string, discovery_status string, error_message string, source_file string")
    params = spark.createDataFrame([('{"csv": {"header": "true"}, "json": {}, "parquet": {}}',)], "READER_OPTIONS string")
    read = backlog.read_in_rounds(spark, manifest, params, {}, f"{tmp_path}/ck", files_per_round=4)
    assert sorted(r.k for r in read.rows.collect()) == [*"0123456", "j"]
    assert sorted((r.record_status, r.source_file.rsplit("/", 1)[-1]) for r in read.errors.collect()) == [
        ("ERROR_LECTURA", "bad.parquet"), ("ERROR_LECTURA", "gone.csv"), ("ERROR_UPSTREAM", "up.csv")
    ]
    assert read.files.count() == 8 and read.output().count() == 11
    again = backlog.read_in_rounds(spark, manifest, params, {}, f"{tmp_path}/ck", files_per_round=4)
    assert again.run == read.run and again.rows.count() == 8 and again.errors.count() == 3
    again.written()
    assert spark.read.parquet(f"{tmp_path}/ck").count() == 8
    nothing = backlog.read_in_rounds(spark, manifest.limit(0), params, {}, f"{tmp_path}/ck")
    assert nothing.rows is None and nothing.errors.count() == nothing.files.count() == 0
