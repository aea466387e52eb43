"""Queries that read no role of a user do not put its companies and roles together."""

from agorakit.plans.inputs import Inputs


def test_staff_without_roles_is_planned_without_them(spark, sf_dir):
    members = Inputs(spark, sf_dir).lazy_company_members
    for names in (["company_id", "company_name", "user_id"], ["company_id", "company_name"]):
        frame = members.select(*names).distinct()
        assert "WORKED_AS" not in frame._jdf.queryExecution().optimizedPlan().toString()
        stored = {tuple(r) for r in members.select(*names).collect()}
        assert {tuple(r) for r in frame.collect()} == stored
