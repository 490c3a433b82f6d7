import pytest
from inkwell.llm import secrets

ID, KEY, URL = "ASIAIOSFODNN7EXAMPLE", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "https://s3.example.org/bucket"
FORMS = {
    "env": f"aws_access_key_id={ID}\naws_secret_access_key={KEY}\nendpoint={URL}",
    "ini": f"aws_access_key_id = {ID}\naws_secret_access_key = {KEY}\nendpoint = {URL}",
    "yaml": f"aws_access_key_id: {ID}\naws_secret_access_key: {KEY}\nendpoint: {URL}",
    "tight": f"aws_access_key_id:{ID}\naws_secret_access_key:{KEY}\nendpoint:{URL}",
    "quoted": f"export ID='{ID}'\nexport AWS_KEY=\"{KEY}\"\nURL='{URL}'",
    "json": f'{{"id":"{ID}","aws_key":"{KEY}","endpoint":"{URL}"}}',
    "padded": f"ID={ID}\nKEY={KEY}==\nURL={URL}",
}


@pytest.mark.parametrize("form", FORMS)
def test_credentials_are_linked_in_every_form(form):
    text = FORMS[form]
    found = {p["kind"]: text[p["start"]:p["end"]] for p in secrets.parts(text)}
    assert found == {"access_id": ID, "secret": KEY + "==" * (form == "padded"), "endpoint": URL}


def test_env_file_reports_its_linked_spans(spark):
    docs = spark.createDataFrame([(1, FORMS["env"]), (2, f"aws_secret_access_key={KEY}")], "doc_id long, text string")
    linked = {r.doc_id: (r.n_linked, r.spans) for r in secrets.scan_secrets(docs).collect()}
    start = FORMS["env"].index(KEY)
    assert linked[1][0] == 3 and f"secret:{start}:{start + len(KEY)}" in linked[1][1]
    assert linked[2][0] == 0
