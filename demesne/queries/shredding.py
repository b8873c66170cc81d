"""Package XML built out of the given orders, and what shredding must find in it."""

from __future__ import annotations

from pyspark.sql import functions as F

from demesne.plans import catalog, discovery, packages as K
from demesne.plans import edges as E
from demesne.queries.estate import Estate
from demesne.queries.registry import query

_NAME = '<DTS:Property DTS:Name="ObjectName">'

XML = f"""concat('<?xml version="1.0"?><!-- built --><DTS:Executable xmlns:DTS="www.microsoft.com/SqlServer/Dts" xmlns:SQLTask="www.microsoft.com/sqlserver/dts/tasks/sqltask" xmlns:ScriptTask="www.microsoft.com/sqlserver/dts/tasks/scripttask" xmlns:ExecutePackageTask="www.microsoft.com/SqlServer/Dts/Tasks/ExecutePackageTask" DTS:ExecutableType="Microsoft.Package">',
'<DTS:Property DTS:Name="PackageFormatVersion">8</DTS:Property>', CASE WHEN o_orderstatus = 'F' THEN '' ELSE concat('{_NAME}Pkg', o_orderkey, '</DTS:Property>') END,
'<DTS:ConnectionManagers><DTS:ConnectionManager DTS:ObjectName="c', o_custkey, '" DTS:CreationName="OLEDB"><DTS:ObjectData><DTS:ConnectionManager ConnectionString="Data Source=h', o_custkey, ';Password=p', o_orderkey, ';T=1"/></DTS:ObjectData></DTS:ConnectionManager></DTS:ConnectionManagers>',
'<DTS:Variables><DTS:Variable DTS:ObjectName="v', o_orderstatus, '"><DTS:VariableValue DTS:DataType="8">a,b</DTS:VariableValue></DTS:Variable><DTS:Variable DTS:ObjectName="w" DTS:Namespace="Sys"/></DTS:Variables>',
'<DTS:Executables><DTS:Executable DTS:ExecutableType="STOCK:SEQUENCE">{_NAME}seq</DTS:Property><DTS:Executables>',
'<DTS:Executable DTS:ExecutableType="Microsoft.ExecuteSQLTask">{_NAME}run</DTS:Property><DTS:ObjectData><SQLTask:SqlTaskData SQLTask:SqlStatementSource=" EXEC s1.p', o_custkey, '; "/></DTS:ObjectData></DTS:Executable>',
'<DTS:Executable DTS:ExecutableType="STOCK:FOREACHLOOP">{_NAME}loop</DTS:Property><DTS:Executables><DTS:Executable DTS:ExecutableType="STOCK:PipelineTask">{_NAME}flow</DTS:Property><DTS:ObjectData><pipeline version="1"><components>',
'<component name="src" componentClassID="Microsoft.OLEDBSource"><properties><property name="AccessMode">2</property><property name="SqlCommand">SELECT a FROM s3.t', o_custkey, ' WHERE a &gt; ?</property></properties></component>',
'<component name="dst" componentClassID="Microsoft.OLEDBDestination"><properties><property name="OpenRowset">[s3].[w', o_orderkey, ']</property></properties></component>',
'</components></pipeline></DTS:ObjectData></DTS:Executable></DTS:Executables></DTS:Executable></DTS:Executables></DTS:Executable>',
CASE WHEN o_orderpriority = '1-URGENT' THEN '<DTS:Executable DTS:ExecutableType="Microsoft.ScriptTask">{_NAME}script</DTS:Property><DTS:ObjectData><ScriptTask:ScriptTaskData><ScriptTask:ScriptCode><![CDATA[if (a < b) return;]]></ScriptTask:ScriptCode></ScriptTask:ScriptTaskData></DTS:ObjectData></DTS:Executable>' ELSE '' END,
'<DTS:Executable DTS:ExecutableType="Microsoft.ExecutePackageTask">{_NAME}child</DTS:Property><DTS:ObjectData><ExecutePackageTask:ExecutePackageTaskData ExecutePackageTask:PackageName="Pkg', o_custkey, '.DTSX"/></DTS:ObjectData></DTS:Executable>',
'<DTS:Executable DTS:ExecutableType="Custom.Task"/></DTS:Executables>',
'<DTS:PrecedenceConstraints><DTS:PrecedenceConstraint DTS:From="Package\\seq" DTS:To="Package\\child"', CASE WHEN o_orderstatus = 'P' THEN ' DTS:Value="Completion"' ELSE '' END, '/></DTS:PrecedenceConstraints></DTS:Executable>')"""

BROKEN = "o_orderpriority = '5-LOW' AND o_orderstatus = 'P'"
KEYS = ["project", "name"]


def packages(t):
    # a raw string literal keeps the backslashes of task paths
    xml = XML.replace("'<DTS:PrecedenceConstraints>", "r'<DTS:PrecedenceConstraints>")
    return t.sql(f"""SELECT o_orderstatus AS project, concat('hint', o_orderkey) AS name,
        CASE WHEN {BROKEN} THEN substr({xml}, 1, 900) ELSE {xml} END AS xml FROM {{orders}}""", orders=t.spread("orders", "o_orderkey"))


SOUND = f"""s AS (SELECT o_orderstatus AS project, 'hint' || o_orderkey AS name, CASE WHEN o_orderstatus = 'F' THEN 'hint' ELSE 'Pkg' END || o_orderkey AS package,
  o_custkey AS c, o_orderkey AS k, o_orderpriority = '1-URGENT' AS scr FROM orders WHERE NOT ({BROKEN}))"""


@query(
    "package_log",
    f"""SELECT 'ssis_package' AS object_type, 'hint' || o_orderkey AS object_name, CASE WHEN {BROKEN} THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN NOT ({BROKEN}) THEN 'xml_parsed' END AS parse_status, CASE WHEN {BROKEN} THEN 'malformed package text' END AS error, CAST(NULL AS DOUBLE) AS duration_ms FROM orders""",
)
def package_log(t):
    return K.parse_log(K.parse(packages(t), parts=()))


@query(
    "package_tasks",
    f"""WITH {SOUND} SELECT project, name, package, '0' AS path, 'seq' AS task_name, 'Sequence Container' AS task_type, NULL AS parent_container, NULL AS executed_package, '' AS written_tables, FALSE AS unparseable_body FROM s
UNION ALL SELECT project, name, package, '0.0', 'run', 'Execute SQL Task', 'seq', NULL, '', FALSE FROM s
UNION ALL SELECT project, name, package, '0.1', 'loop', 'ForEach Loop Container', 'seq', NULL, '', FALSE FROM s
UNION ALL SELECT project, name, package, '0.1.0', 'flow', 'Data Flow Task', 'loop', NULL, '[s3].[w' || k || ']', FALSE FROM s
UNION ALL SELECT project, name, package, '1', 'script', 'Script Task', NULL, NULL, '', TRUE FROM s WHERE scr
UNION ALL SELECT project, name, package, CASE WHEN scr THEN '2' ELSE '1' END, 'child', 'Execute Package Task', NULL, 'Pkg' || c, '', FALSE FROM s
UNION ALL SELECT project, name, package, CASE WHEN scr THEN '3' ELSE '2' END, 'unnamed_Custom.Task', 'Custom.Task', NULL, NULL, '', FALSE FROM s""",
)
def package_tasks(t):
    tasks = K.own_tasks(K.task_rows(packages(t), KEYS)).drop("statements")
    path = F.array_join(F.transform("path", lambda i: i.cast("string")), ".")
    return tasks.withColumn("path", path).withColumn("written_tables", F.array_join("written_tables", "; "))


@query(
    "package_statements",
    f"""WITH {SOUND} SELECT project, name, package, '0.0' AS path, 0 AS statement_no, 'run' AS task_name, 'Execute SQL Task' AS task_type, 'EXEC s1.p' || c || ';' AS sql_text FROM s
UNION ALL SELECT project, name, package, '0.1.0', 0, 'flow :: src', 'Microsoft.OLEDBSource', 'SELECT a FROM s3.t' || c || ' WHERE a > ?' FROM s""",
)
def package_statements(t):
    rows = K.statement_rows(K.task_rows(packages(t), KEYS), KEYS)
    return rows.withColumn("path", F.array_join(F.transform("path", lambda i: i.cast("string")), "."))


@query(
    "package_connections",
    f"""WITH {SOUND} SELECT project, name, package, 'c' || c AS connection_name, 'OLEDB' AS creation_name, 'Data Source=h' || c || ';Password=***REDACTED***;T=1' AS connection_string_redacted FROM s""",
)
def package_connections(t):
    return K.connection_rows(K.parse(packages(t), parts=("connections",)), KEYS)


@query(
    "package_variables",
    f"""WITH {SOUND} SELECT project, name, package, 'v' || project AS variable_name, 'User' AS namespace, '8' AS data_type FROM s
UNION ALL SELECT project, name, package, 'w', 'Sys', 'unknown' FROM s""",
)
def package_variables(t):
    return K.variable_rows(K.parse(packages(t), parts=("variables",)), KEYS)


@query(
    "package_precedence",
    f"""WITH {SOUND} SELECT project, name, package, 0 AS position, 'seq' AS from_task, 'child' AS to_task, CASE WHEN project = 'P' THEN 'Completion' ELSE 'Success' END AS evaluation_value FROM s""",
)
def package_precedence(t):
    return K.precedence_rows(K.parse(packages(t), parts=("precedence",)), KEYS)


@query(
    "package_counts",
    f"""WITH {SOUND} SELECT project, package, CAST(CASE WHEN scr THEN 7 ELSE 6 END AS BIGINT) AS task_count, CAST(1 AS BIGINT) AS connection_managers, CAST(2 AS BIGINT) AS variables, CAST(1 AS BIGINT) AS precedence_constraints,
  CAST(2 AS BIGINT) AS embedded_sql_extracted, CAST(CASE WHEN scr THEN 1 ELSE 0 END AS BIGINT) AS script_tasks, CAST(1 AS BIGINT) AS child_packages FROM s""",
)
def package_counts(t):
    return K.content_counts(packages(t), ["project"])


@query(
    "package_edges",
    f"""WITH {SOUND},
r AS (SELECT package AS source_object, 's3.t' || c AS target_object, 'table' AS target_type, 'reads' AS relationship_type, 'sqlglot' AS discovery_method, 22 AS edge_rank FROM s
  UNION ALL SELECT package, 's1.p' || c, 'stored_procedure', 'calls', 'sqlglot', 23 FROM s
  UNION ALL SELECT package, 'Pkg' || c, 'package', 'executes', 'xml_parsed', 21 FROM s
  UNION ALL SELECT package, 's3.w' || k, 'table', 'writes', 'xml_parsed', 29 FROM s)
SELECT DISTINCT 'db0' AS database, source_object, 'package' AS source_type, target_object, target_type, relationship_type, discovery_method, CAST(edge_rank AS INTEGER) AS edge_rank FROM r""",
)
def package_edges(t):
    tasks = K.task_rows(packages(t), KEYS).withColumn("database", F.lit("db0"))  # written already; read by three streams
    mined = discovery.mine_statements(K.statement_rows(tasks, ["database"]))
    e = Estate(t)
    named = lambda df: df.select("database", F.concat_ws(".", "schema", "name").alias("name"))
    known = E.type_catalog(named(catalog.views(e)), named(catalog.synonyms(e)), named(catalog.procedures(e)), named(catalog.functions(e)))
    keys = ["database", "source_object", "source_type", "parse_status", "position"]
    embedded = mined.select(
        "database", F.col("package").alias("source_object"), F.lit("package").alias("source_type"), "parse_status",
        F.concat("path", F.array(F.col("statement_no").cast("int"))).alias("position"), "referenced_tables", "referenced_procs", "referenced_sequences",
    )
    refs = discovery.reference_rows(embedded, None, keys)
    return E.merge_edges([E.text_edges(refs), E.package_edges(tasks), E.write_edges(tasks)], known)
