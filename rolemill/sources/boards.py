"""Where public board payloads hold the fields of a posting, a row of a table for each board."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolemill.sources.cells import Cell, absolute, below, dated, each, either, epoch, fixed, flag, link, looked_up, marked, matched, number, parts, some, tagged, text, us_date, when, worded_date


@dataclass(frozen=True)
class Board:
    """items: from a parsed payload its list of items (JSON), or patterns of a card or element (HTML, XML); fields: how each is read."""

    fields: dict[str, Cell] = field(default_factory=dict)
    paths: tuple[str, ...] = ("$.jobs",)
    items: Callable[[Column], Column] | None = None
    #: JSON inside a page: the pattern whose first group is the JSON text.
    script: str | None = None
    #: HTML: the pattern of a card. XML: the name of an element.
    card: str | None = None
    element: str | None = None


COMMON: dict[str, Cell] = {
    "ats_id": text("id"), "title": text("title"), "url": text("url"), "location": text("location"), "description": text("description"),
    "posted_at": when("posted_at"), "department": text("department"), "commitment": text("employment_type"),
}
LD_JSON = r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"
NEXT_DATA = r"(?is)<script[^>]*id=\"__NEXT_DATA__\"[^>]*>(.*?)</script>"


def _listed(doc: Column) -> Column:
    """Elements of the item lists among the nodes of linked data."""
    nodes = F.coalesce(F.try_variant_get(doc, "$['@graph']", "array<variant>"), F.array(doc))
    lists = F.filter(nodes, lambda n: F.try_variant_get(n, "$['@type']", "string") == "ItemList")
    return F.flatten(F.transform(lists, lambda n: F.coalesce(F.try_variant_get(n, "$.itemListElement", "array<variant>"), F.array().cast("array<variant>"))))


def _classed(tag: str, name: str) -> str:
    """Pattern of an HTML element of a class, with its content as the group."""
    return rf"<{tag}\b[^>]*class=[\"'][^\"']*\b{name}\b[^\"']*[\"'][^>]*>(.*?)</{tag}>"


# --- fixed values: where public board payloads hold their fields ---
BOARDS: dict[str, Board] = {
    "adp": Board({
        "ats_id": text("itemID"), "title": text("requisitionTitle"), "location": each("requisitionLocations", "nameCode.shortName", sep="; "), "commitment": text("workLevelCode.shortName"),
        "requisition_id": text("clientRequisitionID"), "posted_at": when("postDate"),
        "url": link("https://workforcenow.adp.com/mascsr/default/mdf/recruitment/recruitment.html?cid={company}&jobId={id}", id=text("itemID")),
    }, ("$.jobRequisitions",)),
    "amazon": Board({
        "ats_id": text("id_icims", "icimsJobId", "jobCode", "id"), "title": text("title", "jobTitle"),
        "url": either(absolute("https://www.amazon.jobs", "job_path", "url_next_step", "urlNextStep", "jobUrl"), link("https://www.amazon.jobs/en/jobs/{id}", id=text("id_icims", "icimsJobId", "id"))),
        "location": text("normalized_location", "normalizedLocation", "location"), "department": text("job_category", "jobCategory"), "commitment": text("job_schedule_type", "scheduleType"),
        "description": text("description", "description_short"), "posted_at": either(worded_date("posted_date", "postedDate"), when("createdDate", "created_date")),
    }),
    "apple": Board({
        "ats_id": text("positionId", "id"), "title": text("postingTitle", "title"), "requisition_id": text("reqId", "positionId"),
        "url": link("https://jobs.apple.com/en-us/details/{id}/{slug}", id=text("positionId", "id"), slug=either(text("transformedPostingTitle", "titleSlug"), fixed("role"))),
        "location": each("locations", "name", sep="; "), "team": text("team.teamName", "team.teamCode"), "is_remote": flag("homeOffice"), "description": text("jobSummary"), "posted_at": when("postDateInGMT", "postedDate"),
    }, ("$.res.searchResults",)),
    "arbetsformedlingen": Board({
        "title": text("headline"), "url": text("webpage_url"), "company": text("employer.name"), "team": text("employer.workplace"),
        "location": parts("workplace_address.municipality", "workplace_address.region", "workplace_address.country"), "department": text("occupation_field.label"),
        "commitment": text("working_hours_type.label"), "description": text("description.text"), "salary_summary": text("salary_description", "salary_type.label"),
        "apply_url": text("application_details.url"), "is_remote": flag("remote_work"), "requisition_id": text("external_id", "original_id"), "posted_at": when("publication_date"),
    }, ("$.hits",)),
    "ashby": Board({
        "url": text("jobUrl", "applyUrl"), "apply_url": text("applyUrl"), "location": either(lambda x: F.concat_ws(", ", text("location")(x), each("secondaryLocations", "location")(x))),
        "description": text("descriptionHtml", "descriptionPlain"), "posted_at": when("publishedAt"), "commitment": text("employmentType"), "team": text("team"),
        "is_remote": either(flag("workplaceType", ("remote",), ("onsite", "inoffice", "hybrid")), flag("isRemote", (), ("false",))), "salary_summary": text("compensation.compensationTierSummary", "compensation.scrapeableCompensationSalarySummary"),
    }),
    "avature": Board({
        "ats_id": matched(lambda x: F.regexp_extract(x.item, r"(?is)href=[\"']([^\"']+)", 1), r"/(\d+)/?(?:[?#].*)?$"), "title": marked(r"<h[23][^>]*>(.*?)</h[23]>"), "url": marked(r"href=[\"']([^\"']+)"),
        "location": marked(_classed("span", "list-item-location")), "department": marked(_classed("span", "list-item-department")),
    }, card=r"(<article\b[^>]*class=[\"'][^\"']*\barticle--result\b.*?</article>)"),
    "bamboohr": Board({
        "ats_id": marked(r"bhrPositionID_(\d+)"), "title": marked(r"<a\b[^>]*href=[^>]*>(.*?)</a>"), "location": marked(_classed("span", "BambooHR-ATS-Location")),
        "url": lambda x: below(link("https://{company}.bamboohr.com")(x), marked(r"href=[\"']([^\"']+)")(x)),
    }, card=r"(<li\b[^>]*bhrPositionID_\d+.*?</li>)"),
    "beisen": Board({
        "ats_id": text("JobAdId"), "title": text("JobAdName"), "url": link("https://{company}.zhiye.com/portal/jobs/{id}", id=text("JobAdId")), "location": either(each("LocNames"), text("DetailAddress")),
        "department": text("Org", "Category"), "salary_summary": text("Salary"), "description": parts("Duty", "Require", sep="\n\n"), "posted_at": when("ChangeDate", "PostDate"),
    }, ("$.Data",)),
    "beisen_legacy": Board({
        "ats_id": marked(r"/zpdetail/(\d+)"), "title": marked(r"<a\b[^>]*/zpdetail/\d+[^>]*>(.*?)</a>"), "url": link("https://{company}.zhiye.com/zpdetail/{id}", id=marked(r"/zpdetail/(\d+)")),
        "department": marked(r"<td\b.*?</td>\s*<td[^>]*>(.*?)</td>"), "location": marked(r"<td\b.*?</td>\s*<td\b.*?</td>\s*<td[^>]*>(.*?)</td>"), "posted_at": dated(marked(r"(\d{4}-\d{2}-\d{2})")),
    }, card=r"(<tr\b(?:(?!</tr>).)*?/zpdetail/\d+.*?</tr>)"),
    "breezy": Board({
        "title": text("name"), "company": text("company.name"), "location": either(text("location.name"), parts("location.city", "location.state.name", "location.country.name")),
        "is_remote": flag("location.is_remote"), "commitment": text("type.name"), "salary_summary": text("salary"), "posted_at": when("published_date"),
    }, ("$",)),
    "builtin": Board({"ats_id": matched(text("url"), r"/(\d+)/?$"), "title": text("name")}, items=_listed, script=LD_JSON),
    "bundesagentur": Board({
        "ats_id": text("refnr"), "title": text("titel", "beruf"), "company": text("arbeitgeber"), "url": link("https://www.arbeitsagentur.de/jobsuche/jobdetail/{id}", id=text("refnr")), "apply_url": text("externeUrl"),
        "location": parts("arbeitsort.ort", "arbeitsort.region", "arbeitsort.land"), "department": text("berufsfeld", "branche"), "commitment": text("arbeitszeit"), "description": text("stellenangebotsBeschreibung"),
        "requisition_id": text("hashId"), "posted_at": when("eintrittsdatum", "aktuelleVeroeffentlichungsdatum"),
    }, ("$.stellenangebote",)),
    "bytedance": Board({
        "title": text("title", "name"), "url": link("https://joinbytedance.com/search/{id}", id=text("id")), "location": text("city_info.en_name", "city_info.name"), "department": text("job_category.en_name", "job_category.name"),
        "team": text("job_subject.en_name", "job_subject.name"), "commitment": text("recruit_type.en_name", "recruit_type.name"), "description": parts("description", "requirement", sep="\n\n"), "requisition_id": text("code"),
        "salary_min": number("job_post_info.min_salary"), "salary_max": number("job_post_info.max_salary"), "salary_currency": text("job_post_info.currency"), "posted_at": epoch("publish_time", "post_time"),
    }, ("$.data.job_post_list",)),
    "cornerstone": Board({
        "ats_id": text("requisitionId"), "title": text("displayJobTitle"), "url": link("https://{company}.csod.com/ux/ats/careersite/1/job/{id}?c={company}", id=text("requisitionId")),
        "location": each("locations", "city", "state", "country", sep="; "), "commitment": text("schedule"), "description": text("externalDescription"), "posted_at": either(us_date("postingEffectiveDate"), when("postingEffectiveDate")),
    }, ("$.data.requisitions",)),
    "darwinbox": Board({
        "title": text("designation_display_name", "title", "designation_name"), "url": link("https://{company}.darwinbox.in/ms/candidate/careers/{id}", id=text("id")), "location": either(text("locations", "officelocation_show_arr")),
        "department": text("department_name", "department_name_only", "department"), "team": text("functional_area_name", "functional_area"), "commitment": text("emp_type_name", "emp_type"), "requisition_id": text("internal_job_code"),
        "description": text("jd"), "is_remote": flag("is_remote", ("true", "1"), ("false", "0")), "posted_at": when("posted_on", "created_on"),
    }, ("$.data",)),
    "dayforce": Board({
        "ats_id": text("ReferenceNumber"), "title": text("Title"), "company": text("CompanyName", "ParentCompanyName"), "url": text("JobDetailsUrl"), "apply_url": text("ApplyUrl"), "location": parts("City", "State", "Country"),
        "department": text("JobFamily"), "team": text("JobFunction"), "commitment": text("EmploymentIndicator"), "description": text("Description"), "is_remote": flag("IsVirtualLocation", ("true",), ()), "posted_at": when("DatePosted"),
    }, ("$",)),
    "eightfold": Board({
        "ats_id": text("displayJobId", "display_job_id", "id", "atsJobId", "ats_job_id"), "title": text("name", "posting_name", "title"),
        "url": either(text("canonicalPositionUrl", "canonical_position_url"), link("https://{company}.eightfold.ai/careers/job/{id}", id=text("id", "displayJobId"))),
        "location": either(each("standardizedLocations"), each("locations"), text("location")), "department": text("department"), "description": text("job_description"), "requisition_id": text("atsJobId", "ats_job_id", "displayJobId"),
        "posted_at": epoch("postedTs", "creationTs", "t_create", "t_update", units=1),
    }, ("$.positions", "$.data.positions")),
    "eures": Board({
        "company": text("employerName", "employer.name"), "url": link("https://europa.eu/eures/portal/jv-se/jv-details/{id}?lang=en", id=text("id")), "commitment": text("positionScheduleCode", "positionOfferingCode"),
        "location": lambda x: F.nullif(F.array_join(F.transform(F.map_entries(F.try_variant_get(x.item, "$.locationMap", "map<string,array<string>>")), lambda e: F.when(F.size(e["value"]) > 0, F.concat(e["key"], F.lit(" ("), F.array_join(e["value"], ", "), F.lit(")"))).otherwise(e["key"])), "; "), F.lit("")),
        "description": text("description"), "posted_at": epoch("creationDate"),
    }, ("$.jvs",)),
    "gem": Board({
        "ats_id": text("extId", "id"), "url": link("https://jobs.gem.com/{company}/{id}", id=text("extId", "id")), "location": either(each("locations", "city", "isoCountry", sep="; "), each("locations", "name", sep="; ")),
        "is_remote": some("locations", "isRemote"), "department": text("job.department.name"), "commitment": text("job.employmentType"),
    }, ("$.data.oatsExternalJobPostings.jobPostings",)),
    "getonbrd": Board({
        "title": text("attributes.title"), "company": text("attributes.company.data.id"), "url": either(text("links.public_url"), link("https://www.getonbrd.com/jobs/{id}", id=text("id"))), "location": each("attributes.countries"),
        "is_remote": flag("attributes.remote"), "department": text("attributes.category_name"), "description": text("attributes.description"), "salary_min": number("attributes.min_salary"), "salary_max": number("attributes.max_salary"),
        "salary_period": fixed("MONTH"), "posted_at": epoch("attributes.published_at", units=1),
    }, ("$.data",)),
    "google": Board({
        "ats_id": marked(r"/jobs/results/(\d+)"), "title": marked(r"<h3[^>]*>(.*?)</h3>"), "url": link("https://www.google.com/about/careers/applications/jobs/results/{id}", id=marked(r"/jobs/results/(\d+)")),
        "location": marked(r"<i\b[^>]*>place</i>\s*<span[^>]*>(.*?)</span>"), "company": marked(r"<i\b[^>]*>corporate_fare</i>\s*<span[^>]*>(.*?)</span>"),
    }, card=r"(<li\b(?:(?!</li>).)*?jobs/results/\d+.*?</li>)"),
    "greenhouse": Board({
        "url": text("absolute_url"), "company": text("company_name"), "location": text("location.name"), "department": each("departments", "name"), "description": text("content"),
        "requisition_id": lambda x: F.when(~F.lower(text("requisition_id")(x)).isin("see opening id", "tbd", "n/a", "tba"), text("requisition_id")(x)), "posted_at": when("first_published", "updated_at"),
        "salary_min": lambda x: _span(x, "min_cents", F.array_min), "salary_max": lambda x: _span(x, "max_cents", F.array_max), "salary_currency": lambda x: F.upper(text("pay_input_ranges[0].currency_type")(x)),
    }),
    "gupy": Board({
        "title": text("title", "name"), "url": either(absolute("https://{company}.gupy.io", "jobUrl"), link("https://{company}.gupy.io/jobs/{id}", id=text("id"))),
        "location": parts("workplace.address.city", "workplace.address.state", "workplace.address.country"), "is_remote": flag("workplace.workplaceType", ("remote",), ("onsite", "hybrid")), "commitment": text("type"), "posted_at": when("publishedAt"),
    }, ("$.props.pageProps.jobs",), script=NEXT_DATA),
    "herp": Board({
        "ats_id": marked(r"href=[\"'][^\"']*/v1/[^/\"']+/([^/\"'?#]+)"), "title": marked(_classed("h2", "requisition-list-card__title")), "department": marked(_classed("span", "career-page-group-name-tag__text")),
        "url": link("https://herp.careers/v1/{company}/{id}", id=marked(r"href=[\"'][^\"']*/v1/[^/\"']+/([^/\"'?#]+)")),
    }, card=r"(<li\b[^>]*requisition-list-card\b.*?</li>)"),
    "hrmos": Board({
        "ats_id": marked(r"href=[\"'][^\"']*/jobs/([A-Za-z0-9._-]+)"), "title": marked(r"<h2[^>]*>(.*?)</h2>"), "url": link("https://hrmos.co/pages/{company}/jobs/{id}", id=marked(r"href=[\"'][^\"']*/jobs/([A-Za-z0-9._-]+)")),
        "location": marked(_classed("span", "sg-tag-location")), "description": marked(_classed("div", "pg-list-cassette-body")),
    }, card=r"(<li\b[^>]*\bpg-list-cassette\b.*?</li>)"),
    "icims": Board({
        "ats_id": marked(r"/jobs/(\d+)/"), "title": marked(r"<h3[^>]*>(.*?)</h3>"), "url": marked(r"href=[\"'](https?://[^\"']*/jobs/\d+/[^\"']*)"), "location": marked(r"Job Locations\s*</span>\s*<span[^>]*>(.*?)</span>"),
        "posted_at": dated(marked(r"title=[\"'](\d{1,2}/\d{1,2}/\d{4})")),
    }, card=r"(<li\b[^>]*iCIMS_JobCardItem.*?</li>)"),
    "infojobs_es": Board({
        "ats_id": text("code"), "url": absolute("https://www.infojobs.net", "link"), "company": text("companyName"), "location": text("city"), "commitment": text("contractType", "workday"), "salary_summary": text("salary"), "posted_at": when("publishedAt"),
    }, ("$.offers",)),
    "jazzhr": Board({
        "ats_id": marked(r"/apply/jobs/details/([A-Za-z0-9_-]+)"), "title": marked(_classed("a", "job_title_link")), "url": link("https://{company}.applytojob.com/apply/jobs/details/{id}", id=marked(r"/apply/jobs/details/([A-Za-z0-9_-]+)")),
        "department": marked(_classed("span", "resumator_department")), "location": marked(r".*<td[^>]*>(.*?)</td>"),
    }, card=r"(<tr\b[^>]*id=[\"']row_job_.*?</tr>)"),
    "jobbankca": Board({
        "ats_id": marked(r"article-(\d+)"), "title": marked(_classed("span", "noctitle")), "url": link("https://www.jobbank.gc.ca/jobsearch/jobposting/{id}", id=marked(r"article-(\d+)")), "company": marked(_classed("li", "business")),
        "location": marked(_classed("li", "location")), "salary_summary": marked(_classed("li", "salary")), "posted_at": dated(marked(_classed("li", "date"))),
    }, card=r"(<article\b[^>]*article-\d+.*?</article>)"),
    "jobs_cz": Board({
        "ats_id": marked(r"data-jobad-id=[\"'](\d+)"), "title": marked(r"<a\b[^>]*data-jobad-id[^>]*>(.*?)</a>"), "url": marked(r"<a\b[^>]*href=[\"']([^\"']+)"), "company": marked(r"<span\b[^>]*translate=[\"']no[\"'][^>]*>(.*?)</span>"),
        "location": marked(r"<li\b[^>]*serp-locality[^>]*>(.*?)</li>"), "salary_summary": marked(r"<span\b[^>]*Tag--success[^>]*>(.*?)</span>"),
    }, card=r"(<article\b[^>]*SearchResultCard\b.*?</article>)"),
    "jobsch": Board({
        "ats_id": text("job_id"), "company": text("company_name"), "url": either(text("_links.detail_en.href", "_links.detail_de.href", "_links.detail_fr.href", "_links.detail_it.href"), link("https://www.jobs.ch/en/vacancies/detail/{id}/", id=text("job_id"))),
        "location": text("place"), "posted_at": when("publication_date", "initial_publication_date"),
    }, ("$.documents",)),
    "jobvite": Board({
        "ats_id": marked(r"/job/([A-Za-z0-9_-]+)"), "title": marked(r"<a\b[^>]*/job/[^>]*>(.*?)</a>"), "url": link("https://jobs.jobvite.com/{company}/job/{id}", id=marked(r"/job/([A-Za-z0-9_-]+)")), "location": marked(_classed("td", "jv-job-list-location")),
    }, card=r"(<tr\b(?:(?!</tr>).)*?/job/[A-Za-z0-9_-]+.*?</tr>)"),
    "join_com": Board({
        "url": either(text("url"), link("https://join.com/companies/{company}/{id}", id=text("idParam", "id"))), "location": either(text("location.name"), parts("city.cityName", "city.countryName")), "department": text("department.name"),
        "commitment": text("employmentType.name"), "posted_at": when("publishedAt", "createdAt"),
    }, ("$.items",)),
    "keka": Board({
        "url": link("https://{company}.keka.com/careers/jobdetails/{id}", id=text("id")), "location": each("jobLocations", "city", "state", "countryName", sep="; "), "department": text("departmentName"), "commitment": text("jobType"),
        "requisition_id": text("jobNumber"), "salary_min": number("salaryRange.minimum"), "salary_max": number("salaryRange.maximum"), "salary_currency": text("salaryRange.currency"), "posted_at": when("publishedOn"),
    }, ("$",)),
    "lever": Board({
        "title": text("text"), "url": text("hostedUrl"), "apply_url": text("applyUrl"), "location": text("categories.location"), "department": text("categories.department"), "team": text("categories.team"), "commitment": text("categories.commitment"),
        "description": either(lambda x: F.nullif(F.concat_ws("\n\n", text("description")(x), each("lists", "text", "content", sep="\n\n", between="\n")(x)), F.lit("")), text("descriptionPlain")),
        "is_remote": flag("workplaceType", ("remote",), ("onsite", "inoffice", "hybrid")), "salary_min": number("salaryRange.min"), "salary_max": number("salaryRange.max"), "salary_currency": text("salaryRange.currency"),
        "salary_period": lambda x: F.upper(F.regexp_extract(text("salaryRange.interval")(x), "per-(hour|day|week|month|year)", 1)), "posted_at": epoch("createdAt"),
    }, ("$",)),
    "manfred": Board({
        "ats_id": text("slug"), "title": text("position"), "company": text("company.name"), "url": link("https://www.getmanfred.com/job-offers/{slug}", slug=text("slug")), "location": each("locations"), "salary_min": number("salaryFrom"),
        "salary_max": number("salaryTo"), "salary_currency": lambda x: F.when(text("currency")(x) == "€", "EUR").otherwise(F.upper(F.substring(text("currency")(x), 1, 3))), "salary_period": fixed("YEAR"), "posted_at": when("updatedAt"),
    }, items=lambda doc: F.filter(F.try_variant_get(doc, "$", "array<variant>"), lambda x: F.upper(F.try_variant_get(x, "$.status", "string")) == "ACTIVE")),
    "mercor": Board({
        "ats_id": text("listingId"), "company": text("companyName"), "url": link("https://work.mercor.com/jobs/{id}", id=text("listingId")), "commitment": text("commitment"), "is_remote": flag("workArrangement", ("remote",), ("onsite", "hybrid")),
        "salary_min": number("rateMin"), "salary_max": number("rateMax"), "salary_currency": lambda x: F.when(F.coalesce(number("rateMin")(x), number("rateMax")(x)).isNotNull(), "USD"), "posted_at": when("postedAt"),
    }, ("$.listings",)),
    "meta": Board({
        "url": link("https://www.metacareers.com/jobs/{id}/", id=text("id")), "location": each("locations", sep="; "), "team": text("teams[0]"), "department": text("sub_teams[0]"),
    }, ("$.data.job_search_with_featured_jobs.all_jobs", "$.data.job_search_results.results", "$.data.careers.jobs")),
    "moka": Board({
        "url": link("https://app.mokahr.com/social-recruitment/{company}#/job/{id}", id=text("id")), "location": each("locations", "cityName", "provinceName", "country", sep="; "), "department": text("department.name"), "description": text("jobDescription"),
        "commitment": text("commitment"), "posted_at": when("publishedAt", "openedAt", "createdAt"),
    }, ("$.jobs", "$.data.jobs")),
    "oracle": Board({
        "ats_id": text("Id", "RequisitionNumber"), "title": text("Title"), "url": either(text("ExternalURL"), link("https://{company}/hcmUI/CandidateExperience/en/job/{id}", id=text("Id", "RequisitionNumber"))), "location": text("PrimaryLocation"),
        "department": text("Department", "Organization", "BusinessUnit"), "team": text("JobFamilyName", "JobFamily"), "commitment": text("WorkerType", "JobType", "ContractType", "JobSchedule"), "description": text("ShortDescriptionStr"),
        "requisition_id": text("RequisitionNumber", "RequisitionId", "ReqNumber"), "is_remote": flag("WorkplaceTypeCode", ("orafeworkplacetyperemote", "oraremote"), ("oraonsite", "orahybrid")), "posted_at": when("PostedDate", "CreatedOn"),
    }, ("$.items[0].requisitionList",)),
    "pageup": Board({
        "ats_id": marked(r"/job/(\d+)"), "title": marked(_classed("a", "job-link")), "url": lambda x: F.concat(F.lit("https://careers.pageuppeople.com"), marked(r"href=[\"']([^\"']*/job/\d+[^\"']*)")(x)), "location": marked(_classed("span", "location")),
        "commitment": marked(_classed("span", "work-type")), "department": marked(_classed("span", "department")),
    }, card=r"(<tr\b(?:(?!</tr>).)*?job-link.*?</tr>)"),
    "paycom": Board({
        "ats_id": text("jobId"), "title": text("jobTitle"), "url": link("https://www.paycomonline.net/v4/ats/web.php/portal/{company}/jobs/{id}", id=text("jobId")), "location": text("locations"), "commitment": text("positionType"),
        "is_remote": flag("remoteType", ("remote", "fullyremote"), ("onsite", "hybrid")), "posted_at": either(us_date("postedOn"), when("postedOn")),
    }, ("$.jobPostingPreviews",)),
    "paylocity": Board({
        "ats_id": text("JobId"), "title": text("JobTitle"), "url": link("https://recruiting.paylocity.com/Recruiting/Jobs/Details/{id}", id=text("JobId")), "apply_url": link("https://recruiting.paylocity.com/Recruiting/Jobs/Apply/{id}", id=text("JobId")),
        "location": either(text("LocationName"), parts("JobLocation.City", "JobLocation.State", "JobLocation.Country")), "department": text("HiringDepartment"), "is_remote": flag("IsRemote"), "posted_at": when("PublishedDate"),
    }, items=lambda doc: F.filter(F.try_variant_get(doc, "$.Jobs", "array<variant>"), lambda x: ~F.coalesce(F.try_variant_get(x, "$.IsInternal", "boolean"), F.lit(False))), script=r"(?s)window\.pageData\s*=\s*(\{.*?\});"),
    "personio": Board({
        "ats_id": text("id", "jobId", "uuid"), "title": text("name", "title", "subcompany"), "url": either(text("url"), link("https://{company}.jobs.personio.de/job/{id}", id=text("id", "jobId", "uuid"))),
        "location": text("office.name", "office", "location.name", "location.city"), "department": text("department.name", "department"), "commitment": text("schedule", "employmentType"), "posted_at": when("createdAt", "created_at"),
    }, ("$", "$.data", "$.jobs", "$.results", "$.items")),
    "phenom": Board({
        "ats_id": text("jobId", "id"), "title": text("title", "jobTitle"), "url": either(absolute("https://{company}", "jobUrl", "url"), link("https://{company}/job/{id}", id=text("jobId", "id"))),
        "location": either(text("location", "cityState", "cityStateCountry"), parts("city", "state", "country")), "department": text("department", "category"), "commitment": text("jobType"), "requisition_id": text("jobSeqNo"),
        "description": text("description", "descriptionTeaser"), "posted_at": when("postedDate", "dateCreated", "createdAt"),
    }, ("$.refineSearch.data.jobs", "$.data.jobs", "$.jobs")),
    "pinpoint": Board({
        "location": either(text("location.name"), parts("location.city", "location.province", "location.country")), "department": text("job.department.name"), "commitment": text("schedule", "employment_type"), "requisition_id": text("reference"),
        "is_remote": flag("workplace_type", ("remote",), ("onsite", "hybrid")), "salary_min": lambda x: F.when(text("compensation_visible")(x) == "true", number("compensation_minimum")(x)),
        "salary_max": lambda x: F.when(text("compensation_visible")(x) == "true", number("compensation_maximum")(x)), "salary_currency": lambda x: F.when(text("compensation_visible")(x) == "true", text("compensation_currency")(x)), "posted_at": when("first_published_at"),
    }, ("$.data",)),
    "programathor": Board({
        "ats_id": marked(r"href=[\"']/jobs/(\d+)-"), "title": marked(r"<h3[^>]*>(.*?)(?:<span[^>]*>NOVA</span>\s*)?</h3>"), "url": lambda x: F.concat(F.lit("https://programathor.com.br"), marked(r"href=[\"'](/jobs/\d+-[^\"']+)")(x)),
        "company": marked(r"fa-briefcase[^>]*>\s*</i>([^<]+)"), "location": marked(r"fa-map-marker-alt[^>]*>\s*</i>([^<]+)"), "salary_summary": marked(r"fa-money-bill-alt[^>]*>\s*</i>([^<]+)"), "commitment": marked(r"fa-file-alt[^>]*>\s*</i>([^<]+)"),
    }, card=r"(<div class=[\"']cell-list.*?</a>\s*</div>)"),
    "recruitee": Board({
        "ats_id": text("id", "slug"), "title": text("title", "position"), "company": text("company_name"), "url": either(text("careers_url", "careers_apply_url"), link("https://{company}.recruitee.com/o/{slug}", slug=text("slug", "id"))),
        "apply_url": text("careers_apply_url"), "location": either(lambda x: F.when(~text("location")(x).startswith("{"), text("location")(x)), parts("city", "state_code", "country_code")), "is_remote": flag("remote"),
        "department": text("department", "department_name"), "commitment": text("employment_type_code", "employment_type"), "description": parts("description", "requirements", sep="\n\n"), "salary_min": number("salary.min"), "salary_max": number("salary.max"),
        "salary_currency": text("salary.currency"), "posted_at": lambda x: F.regexp_replace(text("created_at", "published_at")(x), " UTC$", "Z").try_cast("timestamp"),
    }, ("$.offers",)),
    "recruiterbox": Board({
        "url": text("hosted_url", "url"), "company": text("client_name"), "location": parts("location.city", "location.state", "location.country"), "is_remote": flag("allows_remote"), "team": text("team"), "commitment": text("position_type"),
        "posted_at": when("created_on", "updated_on"),
    }, ("$.objects",)),
    "remoteok": Board({
        "title": text("position", "title"), "company": text("company"), "apply_url": text("apply_url"), "salary_min": number("salary_min"), "salary_max": number("salary_max"), "salary_period": fixed("YEAR"),
        "salary_currency": lambda x: F.when(F.coalesce(number("salary_min")(x), number("salary_max")(x)).isNotNull(), "USD"), "posted_at": either(epoch("epoch", units=1), when("date")),
    }, ("$",)),
    "rippling": Board({
        "ats_id": text("uuid", "id"), "title": text("name", "title"), "url": either(text("url", "hostedUrl"), link("https://ats.rippling.com/{company}/jobs/{id}", id=text("uuid", "id"))),
        "location": text("workLocation.displayName", "workLocation.label", "location.displayName", "workLocation.city"), "department": text("department.label", "department.id", "department"), "commitment": text("employmentType"), "posted_at": when("createdAt", "created_at"),
    }, ("$", "$.jobs", "$.items")),
    "seek": Board({
        "company": text("advertiser.description", "companyName"), "url": link("https://www.seek.com.au/job/{id}", id=text("id")), "location": text("locations[0].label"), "department": text("classifications[0].classification.description"),
        "commitment": each("workTypes"), "salary_summary": text("salaryLabel"), "description": text("teaser"), "posted_at": when("listingDate"),
    }, ("$.data",)),
    "smartrecruiters": Board({
        "title": text("name"), "url": link("https://jobs.smartrecruiters.com/{company}/{id}", id=text("id")), "location": either(text("location.fullLocation"), parts("location.city", "location.region", "location.country")), "is_remote": flag("location.remote"),
        "department": text("department.label"), "team": text("function.label"), "commitment": text("typeOfEmployment.label"), "requisition_id": text("refNumber"), "posted_at": when("releasedDate"),
    }, ("$.content",)),
    "softgarden": Board({
        "ats_id": text("identifier.value"), "company": text("hiringOrganization.name"), "location": parts("jobLocation.address.postalCode", "jobLocation.address.addressLocality", "jobLocation.address.addressCountry"), "commitment": text("employmentType"),
        "posted_at": when("datePosted"),
    }, items=lambda doc: F.transform(F.try_variant_get(doc, "$.dataFeedElement", "array<variant>"), lambda x: F.try_variant_get(x, "$.item", "variant"))),
    "successfactors": Board({
        "ats_id": tagged("g:id", "guid"), "title": tagged("title"), "url": tagged("link"), "company": tagged("g:employer"), "location": tagged("g:location"), "department": tagged("g:job_function"), "commitment": tagged("g:job_type", "g:employment_type"),
        "description": tagged("description"), "posted_at": dated(tagged("pubDate", "postDate", "publishedDate", "date")),
    }, element="item"),
    "taleo": Board({
        "ats_id": marked(r"\brid=(\d+)"), "title": marked(r"<a\b[^>]*>(.*?)</a>"), "url": marked(r"href=[\"']([^\"']+)"),
    }, card=r"(<a\b[^>]*viewRequisition[^>]*>.*?</a>)"),
    "teamtailor": Board({
        "ats_id": tagged("guid"), "title": tagged("title"), "url": tagged("link"), "department": tagged("tt:department"), "description": tagged("description"), "posted_at": dated(tagged("pubDate")),
        "location": lambda x: F.nullif(F.concat_ws(", ", tagged("tt:city")(x), tagged("tt:country")(x)), F.lit("")), "is_remote": lambda x: F.when(F.lower(tagged("remoteStatus")(x)) == "fully", True).when(tagged("remoteStatus")(x).isNotNull(), False),
    }, element="item"),
    "tesla": Board({
        "ats_id": text("id", "ji"), "title": text("t", "title"), "url": link("https://www.tesla.com/careers/search/job/{id}", id=text("id", "ji")), "location": looked_up("lookup.locations", "l"), "department": looked_up("lookup.departments", "d"),
    }, ("$.listings",)),
    "thehub": Board({
        "ats_id": text("id", "_id"), "company": text("company.name"), "url": link("https://thehub.io/jobs/{id}", id=text("id", "_id")), "location": either(text("location.address"), parts("location.locality", "location.country")), "is_remote": flag("isRemote"),
        "apply_url": text("link"), "salary_min": number("salaryRange.from", "salaryRange.min", "salaryRange.low"), "salary_max": number("salaryRange.to", "salaryRange.max", "salaryRange.high"), "salary_currency": text("salaryRange.currency"),
        "posted_at": when("publishedAt", "approvedAt", "createdAt"),
    }, items=lambda doc: F.filter(F.try_variant_get(doc, "$.docs", "array<variant>"), lambda x: F.upper(F.try_variant_get(x, "$.status", "string")) == "ACTIVE")),
    "tiktok": Board({
        "title": text("title", "name"), "url": link("https://lifeattiktok.com/search/{id}", id=text("id")), "location": text("city_info.en_name", "city_info.name"), "department": text("job_category.en_name", "job_category.name"),
        "team": text("job_subject.en_name", "job_subject.name"), "commitment": text("recruit_type.en_name", "recruit_type.name"), "description": parts("description", "requirement", sep="\n\n"), "requisition_id": text("code"),
        "salary_min": number("job_post_info.min_salary"), "salary_max": number("job_post_info.max_salary"), "salary_currency": text("job_post_info.currency"), "posted_at": epoch("publish_time", "post_time"),
    }, ("$.data.job_post_list",)),
    "uber": Board({
        "url": link("https://www.uber.com/global/en/careers/list/{id}/", id=text("id")), "location": either(each("allLocations", "city", "region", "countryName", sep="; "), parts("location.city", "location.region", "location.countryName")), "team": text("team"),
        "commitment": text("timeType"), "posted_at": when("creationDate", "createdDate", "updatedDate"),
    }, ("$.data.results",)),
    "ukg": Board({
        "ats_id": text("Id"), "title": text("Title"), "url": link("https://recruiting.ultipro.com/{company}/OpportunityDetail?opportunityId={id}", id=text("Id")),
        "location": each("Locations", "Address.City", "Address.State.Name", "Address.Country.Name", sep="; "), "department": text("JobCategoryName"), "requisition_id": text("RequisitionNumber"),
        "commitment": lambda x: F.when(text("FullTime")(x) == "true", "Full time").when(text("FullTime")(x) == "false", "Part time"), "posted_at": when("PostedDate"),
    }, ("$.opportunities",)),
    "usajobs": Board({
        "ats_id": text("MatchedObjectDescriptor.PositionID"), "title": text("MatchedObjectDescriptor.PositionTitle"), "url": text("MatchedObjectDescriptor.PositionURI"), "apply_url": text("MatchedObjectDescriptor.ApplyURI[0]"),
        "company": text("MatchedObjectDescriptor.OrganizationName", "MatchedObjectDescriptor.DepartmentName"), "location": each("MatchedObjectDescriptor.PositionLocation", "LocationName", sep="; "),
        "commitment": text("MatchedObjectDescriptor.PositionSchedule[0].Name"), "description": text("MatchedObjectDescriptor.UserArea.Details.JobSummary"), "salary_min": number("MatchedObjectDescriptor.PositionRemuneration[0].MinimumRange"),
        "salary_max": number("MatchedObjectDescriptor.PositionRemuneration[0].MaximumRange"), "salary_currency": fixed("USD"), "posted_at": when("MatchedObjectDescriptor.PublicationStartDate"),
    }, ("$.SearchResult.SearchResultItems",)),
    "wanted": Board({
        "title": text("position"), "company": text("company.name"), "url": link("https://www.wanted.co.kr/wd/{id}", id=text("id")), "location": either(parts("address.district", "address.location", "address.country"), text("address.full_location")),
    }, ("$.data",)),
    "welcometothejungle": Board({
        "ats_id": text("reference", "objectID"), "title": text("name"), "company": text("organization.name"),
        "url": link("https://www.welcometothejungle.com/en/companies/{org}/jobs/{slug}", org=either(text("organization.reference"), lambda x: x.company), slug=text("slug", "objectID")), "location": parts("offices[0].city", "offices[0].state", "offices[0].country"),
        "department": text("sectors[0].name"), "commitment": text("contract_type"), "is_remote": flag("remote", ("fulltime",), ("no", "partial", "punctual")), "salary_min": number("salary_minimum", "salary_yearly_minimum"), "salary_max": number("salary_maximum"),
        "salary_currency": text("salary_currency"), "posted_at": when("published_at"),
    }, ("$.hits",)),
    "wellfound": Board({
        "ats_id": marked(r"wellfound\.com/jobs/(\d+)-"), "title": marked(r"\[([^\]]+)\]\(https?://wellfound\.com/jobs/"), "url": marked(r"\((https?://wellfound\.com/jobs/[^)]+)\)"),
    }, card=r"(\[[^\]]+\]\(https?://wellfound\.com/jobs/\d+-[^)]*\))"),
    "weworkremotely": Board({
        "ats_id": tagged("guid"), "title": tagged("title"), "url": tagged("link"), "location": tagged("state", "country", "region"), "department": tagged("category"), "commitment": tagged("type"), "description": tagged("description"), "posted_at": dated(tagged("pubDate")),
    }, element="item"),
    "workable": Board({
        "ats_id": text("shortcode", "code", "id"), "url": text("url", "application_url"), "apply_url": text("application_url"), "is_remote": either(flag("telecommuting"), flag("remote")), "commitment": text("type", "employment_type"),
        "location": either(each("locations", "city", "region", "country", sep="; "), parts("location.city", "location.region", "location.country"), parts("city", "state", "country")), "posted_at": when("published_on", "created_at"),
    }),
    "workday": Board({
        "ats_id": either(text("bulletFields[0]"), matched(text("externalPath"), r"([^/]+)$")), "url": absolute("https://{company}", "externalPath"), "location": text("locationsText"), "department": text("jobFamilyGroup"), "commitment": text("timeType"),
        "requisition_id": text("bulletFields[0]"), "is_remote": flag("remoteType", ("remote", "fullyremote"), ("onsite", "hybrid")),
    }, ("$.jobPostings",)),
    "ycombinator": Board({
        "company": text("companyName"), "url": absolute("https://www.ycombinator.com", "url"), "apply_url": text("applyUrl"), "commitment": text("type"), "department": text("prettyRole"), "salary_summary": text("salaryRange"),
    }, ("$",), script=r'(?s)"jobPostings":(\[.*?\])(?=[,}])'),
}


def _span(x, name: str, best: Callable[[Column], Column]) -> Column:
    """The widest bound over the ranges that share the currency of the first one, from cents."""
    ranges = F.try_variant_get(x.item, "$.pay_input_ranges", "array<variant>")
    first = F.upper(F.try_variant_get(x.item, "$.pay_input_ranges[0].currency_type", "string"))
    own = F.filter(ranges, lambda r: F.upper(F.try_variant_get(r, "$.currency_type", "string")) == first)
    found = best(F.transform(own, lambda r: F.nullif(F.try_variant_get(r, f"$.{name}", "double"), F.lit(0.0))))
    return found / 100
