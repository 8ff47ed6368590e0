"""A query against its SQL."""

from tools.check_oracle import compare, connect


def check_query(spark, folder, query, sql):
    rows = [r.asDict() for r in query(spark, folder).collect()]
    result = connect(folder).execute(sql)
    assert compare(rows, result.fetchall(), [d[0] for d in result.description]) is None
