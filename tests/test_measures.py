from lexrev.operators import measures as M


def test_edge_rows(docs):
    d = docs(None, "", "   ", "Wait... what?!")
    stats = {r.doc_id: r for r in M.document_stats(d).collect()}
    an = {r.doc_id: r for r in M.text_analysis(d).collect()}
    for i in (0, 1, 2):
        assert stats[i].word_count == 0 and stats[i].sentence_count == 0
        assert an[i].complexity_score == 0.0 and an[i].readability_level == "unknown"
        assert an[i].legal_jargon_density == 0.0
    assert stats[3].sentence_count == 2 and an[3].readability_level == "easy"


def test_stats_values(docs):
    d = docs("One two three. Four five!\n\nSix seven eight nine ten")
    r = M.document_stats(d).first()
    assert (r.word_count, r.paragraph_count, r.sentence_count, r.character_count) == (10, 2, 2, 50)
    assert r.avg_words_per_paragraph == 5.0 and r.avg_sentences_per_paragraph == 1.0
    assert r.unique_words == 10


def test_legal_elements(docs):
    text = ("The party shall pay; the parties shall not breach the agreement. Penalty for default. "
            "See ADGM Regulations 2020 and Companies Regulations 2015 and ADGM regulation 1999.")
    r = M.legal_elements(docs(text)).first()
    assert r.obligations == 2 and r.parties and not r.terms
    assert r.compliance_indicators == ["ADGM Regulations 2020", "ADGM regulation 1999", "Companies Regulations 2015"]
    assert r.risk_indicators == ["penalty", "breach", "default"]
    assert r.legal_terms == ["agreement", "breach", "parties", "party", "penalty", "regulation"]


def test_language_and_entities(docs):
    text = "The deed was signed and it was amended. Acme Holdings Limited met Beta Co twice. Beta Co agreed."
    an = M.text_analysis(docs(text)).first()
    assert an.passive_voice_count == 2
    orgs = [r.text for r in M.organisations(docs(text)).orderBy("pos").collect()]
    assert orgs == ["Acme Holdings Limited", "Beta Co", "Beta Co"]
    kp = M.key_phrase_table(docs(text)).first().key_phrases
    assert kp[:3] == ["The", "Acme Holdings Limited", "Beta Co"]


def test_features_of_mock_document(docs):
    text = "Articles of Association for Test Company Limited. This document contains governance provisions."
    f = M.features(docs(text)).first()
    assert not f.has_sections and not f.has_tables and f.legal_term_density == 0.0 and f.formality_score == 0.0
