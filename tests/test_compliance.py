from lexrev.operators import compliance as K


def check(spark, types):
    df = spark.createDataFrame([(i, "b", t) for i, t in enumerate(types)], "doc_id long, source string, predicted_type string")
    return K.compliance(df, "source").first()


def test_reference_compliance_check(spark):
    r = check(spark, ["articles_of_association", "memorandum_of_association"])
    assert (r.process, r.status, r.completeness_percentage, r.total_required, r.documents_provided,
            r.documents_matched) == ("company_incorporation", "Incomplete", 40.0, 5, 2, 2)
    assert r.missing_documents == ["board_resolution", "incorporation_application", "register_members_directors"]
    assert r.extra_documents == []
    assert r.recommendations[0] == "Please provide Board Resolution to complete your company incorporation submission"


def test_duplicates_count_for_process(spark):
    r = check(spark, ["articles_of_association", "articles_of_association"])
    assert (r.process, r.documents_provided, r.documents_matched, r.completeness_percentage) == (
        "company_incorporation", 2, 1, 20.0)


def test_other_processes(spark):
    r = check(spark, ["regulatory_filing"])
    assert (r.process, r.completeness_percentage, r.status) == ("licensing_application", 25.0, "Incomplete")
    r = check(spark, ["compliance_policy"])
    assert (r.process, r.completeness_percentage) == ("compliance_filing", 33.3)
    r = check(spark, ["ubo_declaration"])
    assert (r.process, r.status, r.completeness_percentage, r.extra_documents) == (
        "general_submission", "Complete", 100.0, ["ubo_declaration"])


def test_set_operators_partition_required(spark):
    df = spark.createDataFrame([(0, "b", "articles_of_association"), (1, "b", "ubo_declaration"),
                                (2, "b", "memorandum_of_association")], "doc_id long, source string, predicted_type string")
    present = K.present_types(df, "source")
    proc = K.determine_process(df, "source", present=present)
    miss = K.missing_documents(proc, present, "source").count()
    match = K.matched_documents(proc, present, "source").count()
    assert miss + match == 5
    assert [r.doc_type for r in K.extra_documents(proc, present, "source").collect()] == ["ubo_declaration"]


def test_null_batch_is_one_batch(spark):
    df = spark.createDataFrame([(0, None, "articles_of_association"), (1, None, "memorandum_of_association"),
                                (2, "b", "ubo_declaration")], "doc_id long, source string, predicted_type string")
    rows = {r.source: r for r in K.compliance(df, "source").collect()}
    assert rows[None].process == "company_incorporation" and rows[None].documents_matched == 2
    assert rows[None].completeness_percentage == 40.0 and rows["b"].process == "general_submission"
