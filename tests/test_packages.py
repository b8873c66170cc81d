import zipfile

import pytest
from pyspark.sql import functions as F

from demesne.plans import packages as K
from demesne.sources import files

NS = (
    'xmlns:DTS="www.microsoft.com/SqlServer/Dts" xmlns:SQLTask="www.microsoft.com/sqlserver/dts/tasks/sqltask" '
    'xmlns:ScriptTask="www.microsoft.com/sqlserver/dts/tasks/scripttask" '
    'xmlns:ExecutePackageTask="www.microsoft.com/SqlServer/Dts/Tasks/ExecutePackageTask"'
)


def task(kind, name, body=""):
    return f'<DTS:Executable DTS:ExecutableType="{kind}"><DTS:Property DTS:Name="ObjectName">{name}</DTS:Property>{body}</DTS:Executable>'


def package(tasks, name="Main", head="", tail=""):
    title = f'<DTS:Property DTS:Name="ObjectName">{name}</DTS:Property>' if name else ""
    return f'<?xml version="1.0"?><DTS:Executable {NS} DTS:ExecutableType="Microsoft.Package">{title}{head}<DTS:Executables>{tasks}</DTS:Executables>{tail}</DTS:Executable>'


def sql_task(name, text):
    return task("Microsoft.ExecuteSQLTask", name, f'<DTS:ObjectData><SQLTask:SqlTaskData SQLTask:SqlStatementSource="{text}"/></DTS:ObjectData>')


def nested(levels):
    body = sql_task("leaf", "EXEC s.leaf 1 &lt; 2 &amp;amp; &quot;3")
    for i in range(levels, 0, -1):
        body = task("STOCK:SEQUENCE", f"c{i}", f"<DTS:Executables>{body}</DTS:Executables>")
    return body


def rows(make, *texts):
    return make([("P", "F", f"hint{i}", t) for i, t in enumerate(texts)], "project string, folder string, name string, xml string")


def test_broken_package_is_a_failed_row_and_nothing_more(make):
    out = K.shred_packages(rows(make, package(sql_task("a", "SELECT 1")), "<DTS:Executable><half of a package", None), ["project", "name"])
    log = {r["object_name"]: (r["status"], r["parse_status"], r["error"]) for r in out["log"].collect()}
    assert log["hint0"] == ("success", "xml_parsed", None)
    assert log["hint1"][0] == "failed" and log["hint1"][2] and log["hint2"][0] == "failed"
    assert out["packages"].count() == 1 and out["tasks"].count() == 1


def test_order_containers_and_defaults(make):
    flow = task(
        "STOCK:PipelineTask", "flow",
        '<DTS:ObjectData><pipeline><components><component name="src" componentClassID="Src"><properties><property name="SqlCommand"> SELECT 1 FROM s.t </property></properties></component>'
        '<component><properties><property name="SqlCommand">   </property><property name="OpenRowset">[s].[w]</property></properties></component></components></pipeline></DTS:ObjectData>',
    )
    script = task("Microsoft.ScriptTask", "script", "<DTS:ObjectData><ScriptTask:ScriptTaskData><ScriptTask:ScriptCode><![CDATA[a < b]]></ScriptTask:ScriptCode></ScriptTask:ScriptTaskData></DTS:ObjectData>")
    call = task("Microsoft.ExecutePackageTask", "call", '<DTS:ObjectData><ExecutePackageTask:ExecutePackageTaskData ExecutePackageTask:PackageName="Child.DTSX"/></DTS:ObjectData>')
    loop = task("STOCK:FOREACHLOOP", "loop", f"<DTS:Executables>{flow}{script}</DTS:Executables>")
    head = (
        '<DTS:ConnectionManagers><DTS:ConnectionManager DTS:ObjectName="c"><DTS:ObjectData><DTS:ConnectionManager ConnectionString="S=h;Pwd=x"/></DTS:ObjectData></DTS:ConnectionManager></DTS:ConnectionManagers>'
        '<DTS:Variables><DTS:Variable><DTS:VariableValue DTS:DataType="3">0</DTS:VariableValue></DTS:Variable></DTS:Variables>'
    )
    tail = '<DTS:PrecedenceConstraints><DTS:PrecedenceConstraint DTS:From="Package\\loop" DTS:To="Package\\call"/></DTS:PrecedenceConstraints>'
    xml = package(loop + call + '<DTS:Executable DTS:ExecutableType="Odd"/>', None, head, tail)
    out = K.shred_packages(rows(make, xml), ["name"])
    got = [(r["path"], r["task_name"], r["task_type"], r["parent_container"], r["executed_package"], r["unparseable_body"], r["written_tables"]) for r in out["tasks"].orderBy("path").collect()]
    assert got == [
        ([0], "loop", "ForEach Loop Container", None, None, False, []),
        ([0, 0], "flow", "Data Flow Task", "loop", None, False, ["[s].[w]"]),
        ([0, 1], "script", "Script Task", "loop", None, True, []),
        ([1], "call", "Execute Package Task", None, "Child", False, []),
        ([2], "unnamed_Odd", "Odd", None, None, False, []),
    ]
    assert [tuple(r) for r in K.statement_rows(out["tasks"], ["name"]).select("package", "task_name", "task_type", "sql_text").collect()] == [("hint0", "flow :: src", "Src", "SELECT 1 FROM s.t")]
    assert out["connections"].first()["connection_string_redacted"] == "S=h;Pwd=***REDACTED***"
    assert tuple(out["variables"].first())[2:] == ("unnamed", "User", "3")
    assert tuple(out["precedence"].first())[3:] == ("loop", "call", "Success")


@pytest.mark.parametrize("levels", [2, 6, 9, 14])
def test_any_nesting_depth_is_whole(make, levels):
    got = K.own_tasks(K.task_rows(rows(make, package(nested(levels))), ["name"])).collect()
    assert sorted(r["task_name"] for r in got) == sorted([f"c{i}" for i in range(1, levels + 1)] + ["leaf"])
    leaf = next(r for r in got if r["task_name"] == "leaf")
    assert leaf["parent_container"] == f"c{levels}" and leaf["path"] == [0] * (levels + 1)


def test_deep_statements_and_counts_are_whole(make):
    deep = rows(make, package(nested(8)))
    tasks = K.shred_packages(deep, ["name"])["tasks"]
    assert tasks.count() == 9 and K.statement_rows(tasks, ["name"]).first()["sql_text"] == 'EXEC s.leaf 1 < 2 &amp; "3'
    assert tuple(K.content_counts(deep, ["name"]).first())[2:] == (9, 0, 0, 0, 1, 0, 0)


@pytest.mark.parametrize("levels", [1, 5, 8])
def test_sql_below_a_task_belongs_to_it(make, levels):
    flow = task("STOCK:PipelineTask", "flow", '<DTS:ObjectData><pipeline><components><component name="src" componentClassID="C"><properties><property name="SqlCommand">SELECT 2</property></properties></component></components></pipeline></DTS:ObjectData>')
    inner = nested(levels) + flow
    handler = f'<DTS:EventHandlers><DTS:EventHandler DTS:EventName="OnError"><DTS:Executables>{sql_task("log", "INSERT INTO s.log SELECT 1 WHERE 1 &lt; 2 &amp;amp; 3")}</DTS:Executables></DTS:EventHandler></DTS:EventHandlers>'
    xml = package(task("STOCK:FORLOOP", "for", f"{handler}<DTS:Executables>{inner}</DTS:Executables>") + sql_task("last", "SELECT 3"))
    tasks = K.task_rows(rows(make, xml), ["name"])
    assert sorted(r["task_name"] for r in K.own_tasks(tasks).collect()) == ["for", "last"]
    got = {(r["task_name"], r["sql_text"]) for r in K.statement_rows(tasks, ["name"]).collect()}
    assert got == {("for", 'EXEC s.leaf 1 < 2 &amp; "3'), ("for :: src", "SELECT 2"), ("for", "INSERT INTO s.log SELECT 1 WHERE 1 < 2 &amp; 3"), ("last", "SELECT 3")}


def test_elements_are_known_by_their_namespace(make):
    other = package(sql_task("a", "SELECT 1")).replace("DTS:", "d:").replace("xmlns:DTS=", "xmlns:d=")
    foreign = "<root><DTS>x</DTS></root>"
    out = K.shred_packages(rows(make, other, foreign), ["name"])
    assert [r["task_name"] for r in out["tasks"].collect()] == ["a"]
    assert sorted((r["status"], r["error"]) for r in out["log"].collect()) == [("failed", "no package: its namespace is not declared"), ("success", None)]


def test_counts(make):
    xml = package(task("STOCK:SEQUENCE", "s", f"<DTS:Executables>{sql_task('a', 'SELECT 1')}</DTS:Executables>"))
    assert tuple(K.content_counts(rows(make, xml, package("")), ["name"]).orderBy("name").first())[2:] == (2, 0, 0, 0, 1, 0, 0)


def test_files_and_archives(spark, tmp_path, make):
    (tmp_path / "pk").mkdir()
    (tmp_path / "pk" / "My Pkg.dtsx").write_text(package(sql_task("a", "SELECT 1")), encoding="utf-8")
    (tmp_path / "pk" / "note.txt").write_text("x")
    read = files.read_package_dir(spark, str(tmp_path / "pk"), "Pilot")
    assert [(r["project"], r["folder"], r["name"]) for r in read.collect()] == [("Pilot", "Pilot", "My Pkg")]
    folder = tmp_path / "arch" / "Fold"
    folder.mkdir(parents=True)
    with zipfile.ZipFile(folder / "Proj.ispac", "w") as z:
        z.writestr("A.dtsx", package(sql_task("a", "SELECT 1"), "A"))
        z.writestr("Project.params", "x")
        z.writestr("D.dtsx", b"\xff\xfe\xff")
    (folder / "Bad.ispac").write_bytes(b"no zip")
    expected = make([("Fold", "Proj", "A"), ("Fold", "Proj", "B"), ("Fold", "Bad", "C"), ("Fold", "Proj", "D")], "folder string, project string, name string")
    got = {r["name"]: r for r in files.expand_archives(files.read_archives(spark, str(folder)), expected).collect()}
    assert got["A"]["xml"] and got["A"]["error"] is None
    assert got["B"]["error"] == "member not in archive: B.dtsx" and "BadZipFile" in got["C"]["error"]
    assert got["D"]["xml"] is None and "UnicodeDecodeError" in got["D"]["error"]


def test_sql_files_and_batches(spark, tmp_path):
    (tmp_path / "proc_a.sql").write_text("SELECT 1\nGO\n\n  GO  \nSELECT 2 -- GO\n", encoding="utf-8")
    df = files.read_sql_dir(spark, str(tmp_path))
    assert df.first()["object_name"] == "proc_a"
    got = files.split_batches(df, "text").orderBy("batch_no").select("batch").collect()
    assert [r[0] for r in got] == ["SELECT 1", "SELECT 2 -- GO"]
    assert df.filter(F.length("text") > 0).count() == 1


def test_handler_sql_in_any_spelling(make):
    """Single quotes, another order of attributes and CDATA in an event handler are read alike."""
    sql = "<DTS:Executable DTS:ExecutableType='Microsoft.ExecuteSQLTask'><DTS:ObjectData><SQLTask:SqlTaskData xmlns:SQLTask='www.microsoft.com/sqlserver/dts/tasks/sqltask' SQLTask:Connection='c' SQLTask:SqlStatementSource='EXEC s.a \"x\"' SQLTask:Timeout='1'/></DTS:ObjectData></DTS:Executable>"
    flow = "<DTS:Executable><DTS:ObjectData><pipeline><components><component><properties><property dataType='s' name='SqlCommand'><![CDATA[SELECT 1 WHERE 1 < 2]]></property></properties></component></components></pipeline></DTS:ObjectData></DTS:Executable>"
    handler = f"<DTS:EventHandlers><DTS:EventHandler><DTS:Executables>{sql}{flow}</DTS:Executables></DTS:EventHandler></DTS:EventHandlers>"
    xml = package(task("STOCK:SEQUENCE", "box", f"<DTS:Executables>{sql_task('one', 'SELECT 0').replace('</DTS:Executable>', handler + '</DTS:Executable>')}</DTS:Executables>"))
    got = [(r["task_name"], r["sql_text"]) for r in K.statement_rows(K.task_rows(rows(make, xml), ["name"]), ["name"]).collect()]
    assert sorted(got) == [("one", 'EXEC s.a "x"'), ("one", "SELECT 0"), ("one", "SELECT 1 WHERE 1 < 2")]


def _odd_packages():
    handler = f'<DTS:EventHandlers><DTS:EventHandler DTS:EventName="OnError"><DTS:Executables>{sql_task("log", "SELECT 9")}</DTS:Executables></DTS:EventHandler></DTS:EventHandlers>'
    flow = '<DTS:ObjectData><pipeline><components><component name="a"><properties><property name="SqlCommand">SELECT 2</property><property name="SqlCommand"> </property></properties></component><component name="b"/></components></pipeline></DTS:ObjectData>'
    call = '<DTS:ObjectData><ExecutePackageTask:ExecutePackageTaskData xmlns:ExecutePackageTask="e" ExecutePackageTask:PackageName="p"/></DTS:ObjectData>'
    code = '<DTS:ObjectData><ScriptTask:ScriptTaskData xmlns:ScriptTask="s">x</ScriptTask:ScriptTaskData></DTS:ObjectData>'
    inner = sql_task("in", "SELECT 1") + task("Microsoft.ScriptTask", "code", code) + task("Microsoft.ExecutePackageTask", "call", call)
    head = '<DTS:ConnectionManagers><DTS:ConnectionManager DTS:ObjectName="c"><DTS:ObjectData><x>1</x></DTS:ObjectData></DTS:ConnectionManager><DTS:ConnectionManager/></DTS:ConnectionManagers><DTS:Variables><DTS:Variable DTS:ObjectName="v"/>text</DTS:Variables>'
    tail = '<DTS:PrecedenceConstraints><DTS:PrecedenceConstraint DTS:From="Package\\a" DTS:To="Package\\b"/></DTS:PrecedenceConstraints>'
    return [
        package(task("STOCK:FORLOOP", "for", f"{handler}<DTS:Executables>{inner}</DTS:Executables>") + task("STOCK:PipelineTask", "flow", flow), "one", head, tail),
        package(task("STOCK:SEQUENCE", "seq", f"{handler}<DTS:Executables>{inner}{task('STOCK:FORLOOP', 'for', f'<DTS:Executables>{nested(7)}</DTS:Executables>')}</DTS:Executables>"), "two"),
        package(nested(8) + "<DTS:Executable/>", "three", head),
        package("", "four"),
    ]


def test_counts_and_flow_agree_with_the_tasks(make):
    """The lean readings find what the whole one finds, in every place SQL and tasks can stand."""
    packages = rows(make, *_odd_packages())
    tasks = K.task_rows(packages, ["name"])
    own = F.col("owner").isNull()
    held = tasks.groupBy("package").agg(F.count_if(own), F.sum(F.size("statements")), F.count_if("unparseable_body"), F.count("executed_package"))
    want = {r[0]: tuple(r)[1:] for r in held.collect()} | {"four": (0, 0, 0, 0)}
    cols = ["task_count", "embedded_sql_extracted", "script_tasks", "child_packages"]
    counts = {r["package"]: r for r in K.content_counts(packages, ["name"]).collect()}
    assert {p: tuple(r[c] for c in cols) for p, r in counts.items()} == want
    heads = [(r["connection_managers"], r["variables"], r["precedence_constraints"]) for r in (counts["one"], counts["two"], counts["three"])]
    assert heads == [(2, 1, 1), (0, 0, 0), (2, 1, 0)]
    names, links = K.control_flow(packages, ["name"])
    told = lambda df: sorted((r["name"], r["task_name"]) for r in df.collect())
    assert told(names) == told(K.own_tasks(tasks))
    assert [(r["from_task"], r["to_task"]) for r in links.collect()] == [("a", "b")]


def test_packages_of_one_name_are_counted_apart(make):
    """Counts stay in the row of their package: nothing is added up over packages that share keys and a name."""
    packages = rows(make, package(sql_task("a", "SELECT 1"), "p"), package(sql_task("a", "SELECT 1") + sql_task("b", "SELECT 2"), "p")).withColumn("k", F.lit(1))
    assert sorted(r["task_count"] for r in K.content_counts(packages, ["k"]).collect()) == [1, 2]
