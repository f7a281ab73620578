"""A writer that dies between any two steps leaves the old table or the new one."""

import pytest

from acopio import contracts as C
from acopio import swap
from acopio.plans.writing import write_stock_delta, write_tables
from acopio.sinks import tables as sinks
from acopio.sources import tables
from tests.test_writing import data, rows, spec, stock

STEPS = ("move", "delete", "write_text")


class Killed(BaseException):
    """Not an error that a writer may handle: the process is gone."""


def dying_after(monkeypatch, steps):
    """Let the file operations of a swap happen ``steps`` times, then stop before the next one."""
    left = [steps]
    for name in STEPS:
        real = getattr(swap.Folder, name)

        def step(self, *args, _real=real):
            if left[0] == 0:
                raise Killed
            left[0] -= 1
            return _real(self, *args)

        monkeypatch.setattr(swap.Folder, name, step)
    return left


def killed_everywhere(monkeypatch, begin, write, read, old, new):
    """Write over the old table as often as the write has steps, dying one step later each time."""
    seen, steps = [], 0
    while True:
        begin(steps)
        assert read(steps) == old
        with monkeypatch.context() as m:
            left = dying_after(m, steps)
            try:
                write(steps)
                done = True
            except Killed:
                done = False
            unused = left[0]
        got = read(steps)
        assert got in (old, new), f"after {steps} steps: {got}"
        seen.append(got == new)
        if done:
            assert unused == 0 and got == new
            break
        write(steps)
        assert read(steps) == new
        steps += 1
    assert seen == sorted(seen) and not seen[0] and steps > 3


def frame(spark, *r):
    return spark.createDataFrame(list(r), "v int, periodo string")


LAYOUT = "v int, periodo string"


def test_history(spark, tmp_path, monkeypatch):
    at = lambda i: str(tmp_path / f"h{i}")
    killed_everywhere(
        monkeypatch,
        lambda i: sinks.write_history(frame(spark, (1, "a"), (2, "b"), (3, "c")), at(i)),
        lambda i: sinks.write_history(frame(spark, (8, "b"), (9, "d"), (7, None)), at(i)),
        lambda i: rows(tables.read_table(spark, at(i), schema=frame(spark, (1, "a")).schema), "v", "periodo"),
        [(1, "a"), (2, "b"), (3, "c")],
        [(1, "a"), (3, "c"), (7, None), (8, "b"), (9, "d")],
    )


def test_replacement_by_condition(spark, tmp_path, monkeypatch):
    at = lambda i: str(tmp_path / f"r{i}")
    killed_everywhere(
        monkeypatch,
        lambda i: sinks.write_history(frame(spark, (1, "a"), (2, "b"), (3, "c"), (4, "x")), at(i)),
        lambda i: sinks.replace_where(frame(spark, (9, "b")), at(i), "periodo < 'd'"),
        lambda i: rows(tables.read_table(spark, at(i), schema=frame(spark, (1, "a")).schema), "v", "periodo"),
        [(1, "a"), (2, "b"), (3, "c"), (4, "x")],
        [(4, "x"), (9, "b")],
    )


def test_stock(spark, tmp_path, monkeypatch):
    at = lambda i: str(tmp_path / f"s{i}")
    killed_everywhere(
        monkeypatch,
        lambda i: sinks.write_stock(frame(spark, (1, "a"), (2, "a")).repartition(2), at(i)),
        lambda i: sinks.write_stock(frame(spark, (2, "b"), (3, "b")).repartition(2), at(i)),
        lambda i: rows(tables.read_table(spark, at(i)), "v", "periodo"),
        [(1, "a"), (2, "a")],
        [(2, "b"), (3, "b")],
    )


def test_a_stock_may_be_written_from_itself(spark, tmp_path):
    t = str(tmp_path / "t")
    sinks.write_stock(frame(spark, (1, "a")), t)
    sinks.write_stock(tables.read_table(spark, t).selectExpr("v + 1 AS v", "periodo"), t)
    assert rows(tables.read_table(spark, t), "v") == [(2,)]


def test_refused_replacement_leaves_nothing_behind(spark, tmp_path):
    t = str(tmp_path / "t")
    sinks.write_history(frame(spark, (1, "a")), t)
    with pytest.raises(ValueError, match="outside"):
        sinks.replace_where(frame(spark, (2, "z")), t, "periodo = 'a'")
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["periodo=a"]
    assert rows(tables.read_table(spark, t), "v") == [(1,)]


def test_half_written_rows_are_not_a_table(spark, tmp_path):
    t = tmp_path / "t"
    (t / "_swap" / "x" / "new").mkdir(parents=True)
    (t / "_swap" / "x" / "new" / "part-0.parquet").write_bytes(b"half")
    assert not tables.has_files(spark, str(t)) and tables.target_schema(spark, str(t)) is None
    sinks.write_stock(frame(spark, (1, "a")), str(t))
    assert rows(tables.read_table(spark, str(t)), "v") == [(1,)] and not (t / "_swap").exists()


def test_range_where_the_condition_does_not_cover(spark, tmp_path):
    t = str(tmp_path / "t")
    sinks.write_history(frame(spark, (1, "a"), (2, "b"), (3, "c"), (4, "d'\\"), (5, "e")), t)
    used, entries = sinks.replace_covered(frame(spark, (8, "b"), (9, "d'\\")), t, "periodo = 'b'")
    assert used.startswith("periodo between 'b'") and len(entries) == 2
    assert rows(tables.read_table(spark, t, schema=frame(spark, (1, "a")).schema), "v") == [(1,), (5,), (8,), (9,)]
    used, _ = sinks.replace_covered(frame(spark, (7, "a")), t, "v = 1")
    assert used == "periodo between 'a' and 'a'"


def test_written_folders_alone_are_listed(spark, tmp_path):
    t = str(tmp_path / "t")
    sinks.write_history(frame(spark, *((i, f"p{i}") for i in range(20))), t)
    (entry,) = sinks.write_history(frame(spark, (5, "p5")), t)
    back = tables.read_entries(spark, t, [entry], frame(spark, (1, "a")).schema)
    assert rows(back, "v", "periodo") == [(5, "p5")] and len(back.inputFiles()) == 1
    assert "p19" in tables.first_file(spark, t) or "p9" in tables.first_file(spark, t)
    assert tables.read_entries(spark, t, [], frame(spark, (1, "a")).schema).count() == 0


DELTA = "SDELTA_ID string, v string, sdelta_operacion string, sdelta_periodo_compararacion string, periodo string"


@pytest.mark.parametrize("period", ["2024-01", "2024-02"])
def test_change_rows_of_a_load_that_died_are_there_once(spark, tmp_path, period):
    """The load dies after its change rows and before its stock; then it is run again, also with other rows."""
    load = lambda p, *r: write_tables(spark, data(spark, *r), spec(spark, stock(tmp_path, p))).first()
    delta = lambda: rows(spark.read.schema(DELTA).parquet(f"{tmp_path}/t_sdelta").where("sdelta_periodo_compararacion <> ''"), "SDELTA_ID", "v", "sdelta_operacion")
    load("2024-01", ("1", "a"), ("2", "b"))

    def only_changes(*r):
        new = data(spark, *r).selectExpr("k", "v", f"'{period}' AS periodo", "k AS SDELTA_ID")
        write_stock_delta(spark, new, f"{tmp_path}/t", "parquet", C.StepLog())

    want = [("1", "a", "D"), ("2", "c", "U"), ("3", "d", "I")]
    for _ in range(2):
        only_changes(("2", "c"), ("3", "d"))
        assert delta() == want
    assert load(period, ("2", "c"), ("3", "d")).estado == "FINALIZADO"
    assert delta() == want
    load(period, ("2", "c"), ("3", "d"))
    assert delta() == want
    # back and forth within a period: every change is kept
    for v in ("e", "c", "e"):
        load(period, ("2", v), ("3", "d"))
    assert delta() == sorted([*want, ("2", "c", "U"), ("2", "e", "U"), ("2", "e", "U")])


def test_corrected_rows_replace_those_of_the_load_that_died(spark, tmp_path):
    load = lambda p, *r: write_tables(spark, data(spark, *r), spec(spark, stock(tmp_path, p))).first()
    load("2024-01", ("1", "a"))
    wrong = data(spark, ("1", "wrong")).selectExpr("k", "v", "'2024-02' AS periodo", "k AS SDELTA_ID")
    write_stock_delta(spark, wrong, f"{tmp_path}/t", "parquet", C.StepLog())
    load("2024-02", ("1", "a"))
    read = spark.read.schema(DELTA).parquet(f"{tmp_path}/t_sdelta")
    assert rows(read, "SDELTA_ID", "v", "periodo") == [("1", "a", "2024-01")]


def test_last_count_is_logged(spark, tmp_path):
    load = lambda p, *r: write_tables(spark, data(spark, *r), spec(spark, stock(tmp_path, p))).first()
    load("2024-01", ("1", "a"), ("2", "b"))
    assert "Conteo Ultima Carga 2" in load("2024-02", ("1", "a")).log_detail
