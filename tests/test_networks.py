"""Networks of companies, locations and alumni: rows put together for each user."""

from agorakit.operators import networks


def test_companies_and_roles_of_a_user_meet_its_groups_apart(spark):
    """A user with three companies and four roles is twelve rows of members, but meets its group seven times."""
    staff = [(f"c{c}", f"C{c}", f"r{r}", f"R{r}", user) for user in (1, 2) for c in range(3) for r in range(4)] + [("c0", "C0", None, None, 3)]
    companies = spark.createDataFrame(staff, "company_id string, company_name string, role_id string, role_title string, user_id long")
    members = spark.createDataFrame([("l", "N", 1), ("l", "N", 3), (None, "N", 2)], "location_id string, country string, user_id long")
    _, firms, jobs = networks._meetings(members, companies, ["location_id", "country"])
    assert (firms.count(), jobs.count()) == (3 + 1 + 3, 4 + 1 + 4)
    assert {(r.company_id, r.user_count) for r in firms.collect()} == {("c0", 1), ("c0", 2), ("c1", 2), ("c2", 2)}
    found = {r.user_id: r for r in networks.location_based_networks(members, companies).collect()}
    assert found[1].company_diversity_score == 3.0 and found[1].role_diversity_score == 4.0
    assert found[1].top_companies == ["C0", "C1", "C2"] and found[1].top_roles == ["R0", "R1", "R2", "R3"]
