import plumbline as pl


def run(df, *rules):
    """check kind or id -> verdict"""
    rows = pl.Suite(rules).verdicts(df).collect()
    assert all(r.success is not None for r in rows)
    return rows


def one(df, rule):
    rows = run(df, rule)
    assert len(rows) == 1
    return rows[0]


def counts(row):
    return row.element_count, row.missing_count, row.unexpected_count


def scan_metrics(df, metric):
    """Run the frame and return a metric of each file scan of its main plan (subqueries aside)."""
    query = df._jdf.queryExecution()
    df.collect()
    found, todo = [], [query.executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
            continue
        if node.nodeName().startswith("Scan "):
            found.append(node.metrics().get(metric).get().value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def plan_of(df):
    """Physical plan before adaptive execution re-plans it."""
    return df._jdf.queryExecution().executedPlan().toString()
