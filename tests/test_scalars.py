from pyspark.sql import functions as F

from demesne.functions import scalars as S


def one(make, schema, row, *cols):
    return tuple(make([row], schema).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def test_packed_dates_and_times(make):
    schema = "d int, z int, n int, t int, m int"
    got = one(make, schema, (20240615, 0, None, 91530, 0), *[S.decode_int_date(c) for c in "dzn"], *[S.decode_int_time(c) for c in ("t", "m", "n")])
    assert got == ("2024-06-15", None, None, "09:15:30", "00:00:00", None)


def test_combined_instant_defaults_to_midnight(make):
    day, none = S.decode_int_date("d"), F.lit(None).cast("string")
    assert one(make, "d int, t int", (20240616, 20000), S.combine_date_time(day, S.decode_int_time("t")), S.combine_date_time(day, none), S.combine_date_time(none, none)) == (
        "2024-06-16T02:00:00", "2024-06-16T00:00:00", None,
    )


def test_codes_and_schedules(make):
    rows = [(1, 1), (4, 1), (4, 0), (8, 2), (64, 5), (99, 3), (None, None)]
    got = [tuple(r) for r in make(rows, "k int, i int").select(S.map_code("k", S.RUN_STATUS), S.schedule_label("k", "i")).collect()]
    assert got == [
        ("Succeeded", "Once"), ("In Progress", "Daily (interval=1)"), ("In Progress", "Daily"), (None, "Weekly (interval=2)"),
        (None, "Start Automatically When SQL Server Agent Starts"), (None, "Unknown"), (None, "Unknown"),
    ]


def test_sizes_round_halves_to_even(make):
    rows = [(25,), (16,), (48,), (None,)]
    assert [r[0] for r in make(rows, "p long").select(S.pages_to_mb("p")).collect()] == [0.2, 0.12, 0.38, None]


def test_percent(make):
    rows = [(1, 3), (400, 1000), (1, 800), (3, 800), (5, 0), (5, None), (2, 3)]
    assert [r[0] for r in make(rows, "a long, b long").select(S.percent_of("a", "b")).collect()] == [33.33, 40.0, 0.12, 0.38, None, None, 66.67]


def test_names(make):
    got = one(make, "s string, n string", (None, " [dbo].[Orders] "), S.name_key("n"), S.qualify("s", F.lit("x")), S.qualify(F.lit("a"), F.lit("b"), F.lit("c")),
              S.bare_name(F.lit("a.b.C")), S.drop_suffix(F.lit("P.DTSX"), ".dtsx"), S.drop_suffix(F.lit("P"), ".dtsx"), S.last_path_part(F.lit("Package\\Seq\\T")), S.type_key(F.lit(" [NVARCHAR](200)")))
    assert got == ("dbo.orders", "x", "a.b.c", "C", "P", "P", "T", "nvarchar")


def test_redaction(make):
    text = "Data Source=h;User=u;Password = se=cret;PWD=x"
    assert one(make, "t string", (text,), S.redact("t")) == ("Data Source=h;User=u;Password=***REDACTED***;PWD=***REDACTED***",)


def test_line_counts_follow_all_line_breaks(make):
    texts = ["", "a", "a\n", "a\r\nb", "a\rb\n\n", "\n", "a b\x0bc\x85d", None]
    got = [r[0] for r in make([(t,) for t in texts], "t string").select(S.line_count("t")).collect()]
    assert got == [len(t.splitlines()) if t is not None else None for t in texts]


def test_fingerprint_is_null_safe(make):
    rows = [("a", None), ("a", ""), (None, "a")]
    marks = [r[0] for r in make(rows, "a string, b string").select(S.fingerprint("a", "b")).collect()]
    assert marks[0] == marks[1] != marks[2]


def test_flags_and_latest(make):
    rows = [(1, "ON", "2024-06-15", None), (0, "OFF", None, "2024-06-16"), (None, None, None, None)]
    df = make(rows, "f int, s string, a string, b string")
    got = [tuple(r) for r in df.select(S.tri_state("f"), S.state_is("s"), S.inverted("f"), S.latest_of("a", "b"), S.or_zero("f"), S.null_if("f", 1)).collect()]
    assert got == [(True, True, False, "2024-06-15", 1, None), (False, False, True, "2024-06-16", 0, 0), (None, None, True, None, 0, None)]
