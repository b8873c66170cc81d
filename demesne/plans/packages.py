"""Package XML shredded into flat relations.

The XML is read by from_xml with a declared schema of `LEVELS` levels; nested
tasks are then flattened by higher-order functions inside the row. Nothing is
shuffled. Packages that are nested deeper are read again with twice as many
levels, until none is left: every relation here holds every level.

SQL anywhere below a task that is no container (in a For Loop, in its event
handlers) belongs to that task: such rows have an `owner`, and only their
statements and written tables count.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demesne.functions.scalars import drop_suffix, last_path_part, redact
from demesne.schemas import XML_PARSED
from demesne.session import cut

# --- fixed values: task type codes, their labels, and which of them are containers ---
TASK_LABELS = {
    "Microsoft.ExecuteSQLTask": "Execute SQL Task",
    "Microsoft.ScriptTask": "Script Task",
    "Microsoft.ExecutePackageTask": "Execute Package Task",
    "Microsoft.FileSystemTask": "File System Task",
    "STOCK:PipelineTask": "Data Flow Task",
    "STOCK:SEQUENCE": "Sequence Container",
    "STOCK:FOREACHLOOP": "ForEach Loop Container",
}
CONTAINERS = ["STOCK:SEQUENCE", "STOCK:FOREACHLOOP"]
SCRIPT_TASK = "Microsoft.ScriptTask"
PACKAGE_TASK = "Microsoft.ExecutePackageTask"

#: Levels that one reading of a document opens; not a bound on nesting.
LEVELS = 6
#: Fixed value: the namespace of package elements.
NAMESPACE = "www.microsoft.com/SqlServer/Dts"
CORRUPT = "_corrupt_record"

_PROPERTY = "`DTS:Property`:array<struct<`_DTS:Name`:string,`_VALUE`:string>>"
_COMPONENTS = (
    "`pipeline`:struct<`components`:struct<`component`:array<struct<`_name`:string,`_componentClassID`:string,"
    "`properties`:struct<`property`:array<struct<`_name`:string,`_VALUE`:string>>>>>>>"
)
_STATEMENTS = "array<struct<task_name:string,task_type:string,sql_text:string>>"
_TASK_DATA = (
    "`DTS:ObjectData`:struct<"
    "`SQLTask:SqlTaskData`:struct<`_SQLTask:SqlStatementSource`:string>,"
    "`ExecutePackageTask:ExecutePackageTaskData`:struct<`_ExecutePackageTask:PackageName`:string>,"
    "`ScriptTask:ScriptTaskData`:string," + _COMPONENTS + ">"
)

# What is read of a task: the reader builds a row for every element that it is asked for and skips the rest, which costs far less.
_TASK = {
    "tasks": f"{_PROPERTY},{_TASK_DATA},`DTS:EventHandlers`:string",
    "flow": _PROPERTY,
    "content": f"{_TASK_DATA},`DTS:EventHandlers`:string".replace("`_name`:string,`_componentClassID`:string,", ""),
}


def _executable(depth: int, held: str) -> str:
    inner = "string" if depth <= 1 else f"struct<`DTS:Executable`:array<{_executable(depth - 1, held)}>>"
    return f"struct<`_DTS:ExecutableType`:string,{held},`DTS:Executables`:{inner}>"


_PARTS = {
    "connections": "`DTS:ConnectionManagers`:struct<`DTS:ConnectionManager`:array<struct<`_DTS:ObjectName`:string,"
    "`_DTS:CreationName`:string,`DTS:ObjectData`:struct<`DTS:ConnectionManager`:array<struct<"
    "`_ConnectionString`:string>>>>>>",
    "variables": "`DTS:Variables`:struct<`DTS:Variable`:array<struct<`_DTS:ObjectName`:string,"
    "`_DTS:Namespace`:string,`DTS:VariableValue`:struct<`_DTS:DataType`:string>>>>",
    "precedence": "`DTS:PrecedenceConstraints`:struct<`DTS:PrecedenceConstraint`:array<struct<`_DTS:From`:string,"
    "`_DTS:To`:string,`_DTS:Value`:string>>>",
    # enough to count them
    "sizes": "`DTS:ConnectionManagers`:struct<`DTS:ConnectionManager`:array<string>>,`DTS:Variables`:struct<`DTS:Variable`:array<string>>,"
    "`DTS:PrecedenceConstraints`:struct<`DTS:PrecedenceConstraint`:array<string>>",
}
ALL_PARTS = ("connections", "variables", "precedence", "tasks")


def package_schema(depth: int = LEVELS, parts: tuple[str, ...] = ALL_PARTS) -> str:
    """Schema of the parts asked for; the reader skips the rest of the document."""
    fields = [_PROPERTY] + [_PARTS[p] for p in parts if p in _PARTS]
    for held in (_TASK[p] for p in parts if p in _TASK):
        fields.append(f"`DTS:Executables`:struct<`DTS:Executable`:array<{_executable(depth, held)}>>")
    return f"struct<{','.join(fields)},`{CORRUPT}`:string>"


def parse(packages: DataFrame, xml: str = "xml", depth: int = LEVELS, parts: tuple[str, ...] = ALL_PARTS) -> DataFrame:
    """Packages with their parsed document `_doc`; missing, malformed and foreign XML is told apart by `error`.

    Elements are known by their namespace: another prefix for it is read like the
    usual one.
    """
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "ignoreSurroundingSpaces": "false",
    }
    text = F.col(xml)
    prefix = F.regexp_extract(text, r"\sxmlns:([\w.-]+)\s*=\s*[\"']" + NAMESPACE.replace(".", r"\.") + r"[\"']", 1)
    foreign = prefix == ""
    usual = F.regexp_replace(text, F.concat(F.lit(r"(<|</|\s|xmlns:)"), prefix, F.lit(r"(?=[:=])")), F.lit("$1DTS"))
    text = F.when(foreign | (prefix == "DTS"), text).otherwise(usual)
    doc = F.from_xml(text, package_schema(depth, parts), options)
    kept = [c for c in packages.columns if c != xml]
    # out of a generator the document is computed once; a plain column would be
    # parsed again by every filter that is pushed below it
    parsed = packages.select(*kept, F.explode(F.array(F.struct(doc.alias("doc"), foreign.alias("foreign")))).alias("_read"))
    parsed = parsed.select(*kept, F.col("_read.doc").alias("_doc"), F.col("_read.foreign").alias("_foreign"))
    error = (
        F.when(F.col("_doc").isNull(), "no package text")
        .when(F.col("_doc").getField(CORRUPT).isNotNull(), "malformed package text")
        .when(F.col("_foreign"), "no package: its namespace is not declared")
    )
    return parsed.withColumn("error", error).drop("_foreign")


def parse_log(parsed: DataFrame, name: str = "name") -> DataFrame:
    """One run-log row per package; a broken package is a failed row and nothing more."""
    failed = F.col("error").isNotNull()
    return parsed.select(
        F.lit("ssis_package").alias("object_type"),
        F.col(name).alias("object_name"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(~failed, XML_PARSED).alias("parse_status"),
        "error",
        F.lit(None).cast("double").alias("duration_ms"),
    )


def _object_name(props: Column, fallback: Column) -> Column:
    named = F.filter(props, lambda p: p["_DTS:Name"] == "ObjectName")
    return F.coalesce(F.nullif(F.get(named, 0)["_VALUE"], F.lit("")), fallback)


def _bind(value: Column, body) -> Column:
    """body(value) with the value computed once, also where body repeats it or nests lambdas."""
    return F.get(F.transform(F.array(value), body), 0)


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _commands(component: Column) -> Column:
    """Properties of a data-flow component that hold SQL."""
    return F.filter(component["properties"]["property"], lambda p: (p["_name"] == "SqlCommand") & (_trimmed(p["_VALUE"]) != ""))


def _statements(data: Column, name: Column, label: Column) -> Column:
    """Embedded SQL of one task: its own statement first, then that of its data-flow components."""

    def row(owner: Column, kind: Column, sql: Column) -> Column:
        return F.struct(owner.alias("task_name"), kind.alias("task_type"), sql.alias("sql_text"))

    own_sql = data["SQLTask:SqlTaskData"]["_SQLTask:SqlStatementSource"]
    own = F.filter(F.array(row(name, label, _trimmed(own_sql))), lambda s: own_sql != "")
    components = data["pipeline"]["components"]["component"]

    def of_component(c: Column) -> Column:
        owner = F.concat(name, F.lit(" :: "), F.coalesce(c["_name"], F.lit("unnamed component")))
        kind = F.coalesce(c["_componentClassID"], F.lit("DataFlowComponent"))
        return F.transform(_commands(c), lambda p: row(owner, kind, _trimmed(p["_VALUE"])))

    flows = F.flatten(F.filter(F.transform(components, of_component), lambda a: a.isNotNull()))
    return F.concat(own, F.coalesce(flows, F.array().cast(_STATEMENTS)))


def _writes(data: Column) -> Column:
    """Tables that data-flow destinations write to (their OpenRowset)."""
    components = data["pipeline"]["components"]["component"]
    found = F.transform(
        components,
        lambda c: F.transform(
            F.filter(c["properties"]["property"], lambda p: (p["_name"] == "OpenRowset") & (p["_VALUE"] != "")),
            lambda p: p["_VALUE"],
        ),
    )
    return F.coalesce(F.flatten(F.filter(found, lambda a: a.isNotNull())), F.array().cast("array<string>"))


def _label(kind: Column) -> Column:
    label = kind
    for code, text in TASK_LABELS.items():
        label = F.when(kind == code, text).otherwise(label)
    return label


def _handler_sql(raw: Column, name: Column, label: Column) -> Column:
    """SQL of a task's event handlers, from their inner XML (which has its escapes resolved): of SQL tasks, then of components."""
    found = F.concat(
        F.regexp_extract_all(raw, F.lit(r'(?s)SqlStatementSource\s*=\s*"(.*?)"(?=\s*/?>|\s+[\w:.-]+\s*=\s*")'), F.lit(1)),
        F.regexp_extract_all(raw, F.lit(r'(?s)<property\s[^>]*\bname\s*=\s*"SqlCommand"[^>]*>(.*?)</property>'), F.lit(1)),
    )
    texts = F.filter(F.transform(found, _trimmed), lambda s: s != "")
    rows = F.transform(texts, lambda s: F.struct(name.alias("task_name"), label.alias("task_type"), s.alias("sql_text")))
    return F.coalesce(rows, F.array().cast(_STATEMENTS))


def _tasks(executables: Column, parent: Column, path: Column, owner: Column, depth: int) -> Column:
    """Executables in document order, each before those below it; `owner` is the task that a nested one belongs to."""

    def of_one(task: Column, i: Column) -> Column:
        kind = F.coalesce(task["_DTS:ExecutableType"], F.lit("Unknown"))
        name = _object_name(task["DTS:Property"], F.concat(F.lit("unnamed_"), kind))
        return _bind(F.struct(kind.alias("kind"), name.alias("name")), lambda k: with_name(task, i, k["kind"], k["name"]))

    def with_name(task: Column, i: Column, kind: Column, name: Column) -> Column:
        here = F.concat(path, F.array(i.cast("int")))
        inner = task["DTS:Executables"]
        opens = owner["name"].isNull() & kind.isin(*CONTAINERS)
        mine = F.struct(name.alias("name"), _label(kind).alias("label"))
        below_owner = F.when(opens | owner["name"].isNotNull(), owner).otherwise(mine)
        deepest = depth <= 1
        row = F.array(
            F.struct(
                here.alias("path"),
                name.alias("task_name"),
                kind.alias("kind"),
                parent.alias("parent_container"),
                task["DTS:ObjectData"].alias("data"),
                F.when(~opens, task["DTS:EventHandlers"]).alias("handlers"),
                owner.alias("owner"),
                (F.coalesce(inner != "", F.lit(False)) if deepest else F.lit(False)).alias("cut"),
            )
        )
        if deepest:
            return row
        below = _bind(below_owner, lambda o: _tasks(inner["DTS:Executable"], name, here, o, depth - 1))
        return F.when(inner["DTS:Executable"].isNotNull(), F.concat(row, below)).otherwise(row)

    return F.flatten(F.transform(executables, of_one))


_OWNER = "struct<name:string,label:string>"


def _flat_tasks(depth: int) -> Column:
    top = F.lit(None).cast("string"), F.array().cast("array<int>"), F.lit(None).cast(_OWNER)
    return _tasks(F.col("_doc")["DTS:Executables"]["DTS:Executable"], *top, depth)


def _task_columns(kind: Column, name: Column, data: Column, handlers: Column, owner: Column) -> dict[str, Column]:
    """What a task holds besides its place in the control flow; containers hold nothing themselves."""
    owned = owner["name"].isNotNull()
    container = kind.isin(*CONTAINERS)
    of, as_ = F.coalesce(owner["name"], name), F.coalesce(owner["label"], _label(kind))
    child = data["ExecutePackageTask:ExecutePackageTaskData"]["_ExecutePackageTask:PackageName"]
    label = _label(kind)
    script = (kind == SCRIPT_TASK) & data["ScriptTask:ScriptTaskData"].isNotNull()
    return {
        "task_type": label,
        "statements": F.when(container & ~owned, F.array().cast(_STATEMENTS)).otherwise(F.concat(_statements(data, of, as_), _handler_sql(handlers, of, as_))),
        "executed_package": F.when((kind == PACKAGE_TASK) & ~owned, drop_suffix(child, ".dtsx")),
        "unparseable_body": F.coalesce(script & ~owned, F.lit(False)),
        "written_tables": F.when(container, F.array().cast("array<string>")).otherwise(_writes(data)),
    }


def _task_table(flat: DataFrame, keys: list[str]) -> DataFrame:
    """Task columns beside the `keys`."""
    cols = _task_columns(F.col("kind"), F.col("task_name"), F.col("data"), F.col("handlers"), F.col("owner"))
    return flat.select(
        *keys,
        "package",
        "path",
        "task_name",
        cols["task_type"].alias("task_type"),
        "parent_container",
        *[cols[c].alias(c) for c in ("statements", "executed_package", "unparseable_body", "written_tables")],
        F.col("owner.name").alias("owner"),
    )


@contextmanager
def _room_for(spark: SparkSession, depth: int):
    """Analysis resolves a few nested functions a pass; while a deep expression is analysed, it may take more passes."""
    name = "spark.sql.analyzer.maxIterations"
    before = spark.conf.get(name)
    spark.conf.set(name, max(int(before), 20 * depth))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def task_rows(packages: DataFrame, keys: list[str], xml: str = "xml", depth: int = LEVELS) -> DataFrame:
    """(keys, package, path, task_name, task_type, parent_container, statements, …) of all sound packages, at any nesting.

    `owner` is the task whose SQL a row holds, or NULL for a task of its own
    (`own_tasks`). Only packages with more than `depth` levels are read again.
    """
    out, todo = [], packages.withColumn("_source", F.col(xml))
    rest = [c for c in packages.columns if c != xml and c not in keys]
    while True:
        parsed = parse(todo, xml, depth, ("tasks",)).filter("error is null")
        with _room_for(packages.sparkSession, depth):
            # as the output of a generator, the tasks of a package are flattened once
            flat = parsed.withColumn("package", package_name()).withColumn("_flat", F.explode(F.array(_flat_tasks(depth))))
        open_ = F.coalesce(F.exists("_flat", lambda x: x["cut"]), F.lit(False))
        # told once a package, so that no task row carries the text or the whole list; only that of a package that goes deeper is kept
        flat = flat.select(*keys, *rest, "package", F.when(open_, F.col("_source")).alias("_source"), "_flat").withColumn("_open", F.col("_source").isNotNull())
        # The text of a package that goes deeper stays on its first row; all others have done with theirs.
        rows = flat.select(*keys, *rest, "package", "_source", "_open", F.inline("_flat"))
        rows = rows.withColumn("_source", F.when(F.col("path") == F.array(F.lit(0)), F.col("_source")))
        read = cut(_task_table(rows, [*keys, *rest, "_open", "_source"]))  # parsed once, for both uses
        out.append(read.filter("not _open").drop("_open", "_source", *rest))
        deeper = read.filter("_source is not null").select(*keys, *rest, "_source")
        if deeper.isEmpty():
            return reduce(DataFrame.unionByName, out)
        todo, depth = cut(deeper).withColumn(xml, F.col("_source")), 2 * depth


def _below(executables: Column, owned: Column, depth: int, row, opened_only: bool = False) -> Column:
    """row(task, kind, owned, more) of every executable in document order: `owned` if it only holds SQL of another task,
    `more` if it goes deeper than this reading. `opened_only` leaves out what is owned."""

    def of_one(task: Column) -> Column:
        kind = F.coalesce(task["_DTS:ExecutableType"], F.lit("Unknown"))
        inner, opens = task["DTS:Executables"], ~owned & kind.isin(*CONTAINERS)
        if depth <= 1:
            more = F.coalesce(inner != "", F.lit(False))
            return F.array(row(task, kind, owned, more & opens if opened_only else more))
        here = F.array(row(task, kind, owned, F.lit(False)))
        goes_on = inner["DTS:Executable"].isNotNull()
        inside = _below(inner["DTS:Executable"], F.lit(False) if opened_only else ~opens, depth - 1, row, opened_only)
        return F.when(goes_on & opens if opened_only else goes_on, F.concat(here, inside)).otherwise(here)

    return F.flatten(F.transform(executables, of_one))


def _package_rows(packages: DataFrame, parts: tuple[str, ...], row, made: dict[str, Column], xml: str, depth: int, opened_only: bool = False) -> DataFrame:
    """One row a sound package, read once: all other columns, `package`, and those made of `_doc` and of `_flat`, its tasks.

    Only packages with more than `depth` levels are read again.
    """
    out, rest = [], [c for c in packages.columns if c != xml]
    while True:
        parsed = parse(packages.withColumn("_source", F.col(xml)), xml, depth, parts).filter("error is null")
        with _room_for(packages.sparkSession, depth):
            flat = _below(F.col("_doc")["DTS:Executables"]["DTS:Executable"], F.lit(False), depth, row, opened_only)
            parsed = parsed.withColumn("_flat", F.explode(F.array(flat)))  # out of a generator: flattened once
        more = F.coalesce(F.exists("_flat", lambda x: x["more"]), F.lit(False))
        columns = [package_name().alias("package"), *[c.alias(n) for n, c in made.items()]]
        read = cut(parsed.select(*rest, F.when(more, F.col("_source")).alias("_source"), *columns))
        out.append(read.filter("_source is null").drop("_source"))
        deeper = read.filter("_source is not null").select(*rest, F.col("_source").alias(xml))
        if deeper.isEmpty():
            return reduce(DataFrame.unionByName, out)
        packages, depth = deeper, 2 * depth


def control_flow(packages: DataFrame, keys: list[str], xml: str = "xml", depth: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """(keys, task_name) of the tasks themselves, and (keys, from_task, to_task) of their precedence; one reading, which skips what tasks hold."""

    def row(task: Column, kind: Column, owned: Column, more: Column) -> Column:
        return F.struct(_object_name(task["DTS:Property"], F.concat(F.lit("unnamed_"), kind)).alias("name"), more.alias("more"))

    end = lambda p, side: last_path_part(F.coalesce(p[side], F.lit("")))
    links = F.transform(
        F.col("_doc")["DTS:PrecedenceConstraints"]["DTS:PrecedenceConstraint"],
        lambda p: F.struct(end(p, "_DTS:From").alias("from_task"), end(p, "_DTS:To").alias("to_task")),
    )
    read = _package_rows(packages, ("precedence", "flow"), row, {"names": F.transform("_flat", lambda x: x["name"]), "links": links}, xml, depth, True)
    return read.select(*keys, F.explode("names").alias("task_name")), read.select(*keys, F.inline("links"))


def own_tasks(tasks: DataFrame) -> DataFrame:
    """The tasks themselves, without the rows that only hold SQL of another task."""
    return tasks.filter("owner is null").drop("owner")


def package_name(hint: str = "name") -> Column:
    return _object_name(F.col("_doc")["DTS:Property"], F.col(hint))


def statement_rows(tasks: DataFrame, keys: list[str]) -> DataFrame:
    """Embedded statements in document order (path, statement_no)."""
    return tasks.select(*keys, "package", "path", F.posexplode("statements").alias("statement_no", "_s")).select(
        *keys, "package", "path", "statement_no", "_s.*"
    )


def connection_rows(parsed: DataFrame, keys: list[str]) -> DataFrame:
    items = F.col("_doc")["DTS:ConnectionManagers"]["DTS:ConnectionManager"]
    c = F.col("_c")
    text = F.coalesce(F.get(c["DTS:ObjectData"]["DTS:ConnectionManager"], 0)["_ConnectionString"], F.lit(""))
    return parsed.filter("error is null").select(
        *keys, package_name().alias("package"), F.explode(items).alias("_c")
    ).select(
        *keys,
        "package",
        F.coalesce(c["_DTS:ObjectName"], F.lit("unnamed")).alias("connection_name"),
        F.coalesce(c["_DTS:CreationName"], F.lit("unknown")).alias("creation_name"),
        redact(text).alias("connection_string_redacted"),
    )


def variable_rows(parsed: DataFrame, keys: list[str]) -> DataFrame:
    items = F.col("_doc")["DTS:Variables"]["DTS:Variable"]
    v = F.col("_v")
    return parsed.filter("error is null").select(
        *keys, package_name().alias("package"), F.explode(items).alias("_v")
    ).select(
        *keys,
        "package",
        F.coalesce(v["_DTS:ObjectName"], F.lit("unnamed")).alias("variable_name"),
        F.coalesce(v["_DTS:Namespace"], F.lit("User")).alias("namespace"),
        F.coalesce(v["DTS:VariableValue"]["_DTS:DataType"], F.lit("unknown")).alias("data_type"),
    )


def precedence_rows(parsed: DataFrame, keys: list[str]) -> DataFrame:
    items = F.col("_doc")["DTS:PrecedenceConstraints"]["DTS:PrecedenceConstraint"]
    p = F.col("_p")
    return parsed.filter("error is null").select(
        *keys, package_name().alias("package"), F.posexplode(items).alias("position", "_p")
    ).select(
        *keys,
        "package",
        "position",
        last_path_part(F.coalesce(p["_DTS:From"], F.lit(""))).alias("from_task"),
        last_path_part(F.coalesce(p["_DTS:To"], F.lit(""))).alias("to_task"),
        F.coalesce(p["_DTS:Value"], F.lit("Success")).alias("evaluation_value"),
    )


def shred_packages(packages: DataFrame, keys: list[str], xml: str = "xml", depth: int = LEVELS) -> dict[str, DataFrame]:
    """Everything a package holds: log, packages, tasks, connections, variables, precedence.

    The heads of the documents are parsed once and written; the relations are
    read from that. Embedded statements are a column of the tasks;
    `statement_rows` lists them.
    """
    head = cut(parse(packages, xml, depth, ("connections", "variables", "precedence")))
    return {
        "log": parse_log(head),
        "packages": head.filter("error is null").withColumn("package", package_name()).drop("_doc", "error"),
        "tasks": task_rows(packages, keys, xml, depth),
        "connections": connection_rows(head, keys),
        "variables": variable_rows(head, keys),
        "precedence": precedence_rows(head, keys),
    }


def content_counts(packages: DataFrame, keys: list[str], xml: str = "xml", depth: int = LEVELS) -> DataFrame:
    """What each package holds, in numbers, over all levels: counted inside its row, out of one reading."""

    def row(task: Column, kind: Column, owned: Column, more: Column) -> Column:
        data, container = task["DTS:ObjectData"], kind.isin(*CONTAINERS)
        of_flows = F.aggregate(
            F.transform(data["pipeline"]["components"]["component"], lambda c: F.greatest(F.size(_commands(c)), F.lit(0))), F.lit(0), lambda n, m: n + m
        )
        of_handlers = F.when(task["DTS:EventHandlers"].isNotNull(), F.size(_handler_sql(task["DTS:EventHandlers"], F.lit(""), F.lit(""))))
        sql = (data["SQLTask:SqlTaskData"]["_SQLTask:SqlStatementSource"] != "").cast("int")
        sql = F.coalesce(sql, F.lit(0)) + F.coalesce(of_flows, F.lit(0)) + F.coalesce(of_handlers, F.lit(0))
        script = (kind == SCRIPT_TASK) & data["ScriptTask:ScriptTaskData"].isNotNull()
        child = (kind == PACKAGE_TASK) & data["ExecutePackageTask:ExecutePackageTaskData"]["_ExecutePackageTask:PackageName"].isNotNull()
        return F.struct(
            (~owned).alias("own"),
            F.when(container & ~owned, 0).otherwise(sql).alias("sql"),
            (script & ~owned).alias("script"),
            (child & ~owned).alias("child"),
            more.alias("more"),
        )

    n = lambda arr: F.greatest(F.coalesce(F.size(arr), F.lit(0)), F.lit(0)).cast("bigint")
    doc, flat = F.col("_doc"), F.col("_flat")
    made = {
        "task_count": n(F.filter(flat, lambda x: x["own"])),
        "connection_managers": n(doc["DTS:ConnectionManagers"]["DTS:ConnectionManager"]),
        "variables": n(doc["DTS:Variables"]["DTS:Variable"]),
        "precedence_constraints": n(doc["DTS:PrecedenceConstraints"]["DTS:PrecedenceConstraint"]),
        "embedded_sql_extracted": F.coalesce(F.aggregate(flat, F.lit(0).cast("bigint"), lambda a, x: a + x["sql"]), F.lit(0)),
        "script_tasks": n(F.filter(flat, lambda x: x["script"])),
        "child_packages": n(F.filter(flat, lambda x: x["child"])),
    }
    return _package_rows(packages, ("sizes", "content"), row, made, xml, depth).select(*keys, "package", *made)
