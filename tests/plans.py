"""Reading physical plans in tests."""


def physical_plan(df):
    """Text of the plan before execution."""
    return df._jdf.queryExecution().executedPlan().toString()


def last_executed_plan(spark):
    """Text of the plan of the last finished action, writes included."""
    executions = spark._jsparkSession.sharedState().statusStore().executionsList()
    return executions.last().physicalPlanDescription()


def assert_no_python(df):
    text = physical_plan(df)
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "ExistingRDD"):
        assert node not in text, node
