"""Hosts, domains and links of employers' pages."""

import pytest
from pyspark.sql import functions as F

from rolemill.functions import sites


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).head()["x"]


@pytest.mark.parametrize(("url", "want"), [
    ("https://Careers.Blue-Harbor.example/x?y", "blue-harbor.example"), ("jobs.careers.acme.co.uk", "acme.co.uk"), ("https://acme.breezy.hr/p", None), ("https://www.acme.example:8080", "acme.example"),
    ("https://u:p@jobs.acme.example/", "acme.example"), ("jobs.example", "jobs.example"), ("nohost", None), ("", None), (None, None), ("https://news.acme.example", "news.acme.example"),
])
def test_corporate_domain(spark, url, want):
    assert one(spark, sites.corporate_domain("u"), u=url) == want


@pytest.mark.parametrize(("html", "want"), [
    ("<a href='/about'>About</a><a href='/careers/eng/1'>x</a><a href='/careers'>Careers</a>", "https://acme.example/careers"),
    ("<a href='https://partner.example/careers'>Careers</a>", None),
    ("<a href='https://jobs.acme.example/all'><b>Open roles</b></a><a href='/jobs/1/2/3'>one</a>", "https://jobs.acme.example/all"),
    ("<a href='products/opportunities-map'>Opportunities</a><a href='#jobs'>Jobs</a><a href='mailto:jobs@acme.example'>Jobs</a>", None),
    ("", None),
])
def test_careers_link(spark, html, want):
    assert one(spark, sites.careers_link(F.col("h"), F.col("b"), F.lit("acme.example")), h=html, b="https://acme.example/x/y.html") == want


@pytest.mark.parametrize(("html", "name", "want"), [
    ("<a href='https://www.blueharbor.example/x'>Home</a><a href='https://twitter.com/blueharbor'>t</a>", "Blue Harbor, Inc.", "blueharbor.example"),
    ("<link rel='canonical' href='https://harbor.example/'><a href='https://unrelated.example'>y</a>", "Blue Harbor", "harbor.example"),
    ("<a href='https://unrelated.example'>y</a><a href='https://blueharbor.breezy.hr'>z</a>", "Blue Harbor", None),
    ("<a href='https://any.example'>y</a>", "", None),
])
def test_employer_domain(spark, html, name, want):
    assert one(spark, sites.employer_domain(F.col("h"), F.col("b"), "n"), h=html, b="https://boards.greenhouse.io/blueharbor", n=name) == want
