"""A payload of each board, in its public shape, with the posting it stands for.

@I stands for an id, @T for a title and @C for a city; queries fill them in from the driver's tables, tests with fixed words.
What a sample expects is written by hand beside it, so that a path that reads the wrong place shows. The tenant is always acme.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Sample:
    payload: str
    url: str
    location: str | None = "@C"
    ats_id: str = "@I"
    #: Other fields that the payload holds, as text.
    more: tuple[tuple[str, str], ...] = ()


def _s(payload: str, url: str, location: str | None = "@C", ats_id: str = "@I", **more: str) -> Sample:
    return Sample(payload, url, location, ats_id, tuple(more.items()))


_LD = '<html><script type="application/ld+json">%s</script></html>'

SAMPLES: dict[str, Sample] = {
    "adp": _s('{"jobRequisitions":[{"itemID":"@I","requisitionTitle":"@T","requisitionLocations":[{"nameCode":{"shortName":"@C"}}],"workLevelCode":{"shortName":"Full Time"},"postDate":"2026-03-04T10:00:00Z"}],"meta":{"totalNumber":1}}', "https://workforcenow.adp.com/mascsr/default/mdf/recruitment/recruitment.html?cid=acme&jobId=@I", commitment="Full Time", posted_at="2026-03-04 10:00:00"),
    "amazon": _s('{"jobs":[{"id":"aa-bb","id_icims":"@I","title":"@T","job_path":"/en/jobs/@I/role","normalized_location":"@C","job_category":"Fulfillment","posted_date":"May  6, 2026","job_schedule_type":"Full-time"}]}', "https://www.amazon.jobs/en/jobs/@I/role", department="Fulfillment", posted_at="2026-05-06 00:00:00"),
    "apple": _s('{"res":{"searchResults":[{"positionId":"@I","reqId":"R-1","postingTitle":"@T","transformedPostingTitle":"the-role","locations":[{"name":"@C"}],"team":{"teamName":"Hardware"},"homeOffice":false,"postDateInGMT":"2026-02-01T08:30:00Z"}]}}', "https://jobs.apple.com/en-us/details/@I/the-role", team="Hardware", is_remote="false", requisition_id="R-1"),
    "arbetsformedlingen": _s('{"hits":[{"id":"@I","headline":"@T","webpage_url":"https://af.example/annonser/@I","employer":{"name":"Verkstad AB","workplace":"Norra"},"workplace_address":{"municipality":"@C"},"working_hours_type":{"label":"Heltid"},"remote_work":true}]}', "https://af.example/annonser/@I", commitment="Heltid", is_remote="true", company="Verkstad AB"),
    "ashby": _s('{"jobs":[{"id":"@I","title":"@T","jobUrl":"https://jobs.ashbyhq.com/acme/@I","location":"@C","secondaryLocations":[{"location":"Anywhere"}],"workplaceType":"Hybrid","isRemote":true,"publishedAt":"2026-01-05T00:00:00.000+00:00","employmentType":"FullTime"}]}', "https://jobs.ashbyhq.com/acme/@I", "@C, Anywhere", is_remote="false", commitment="FullTime"),
    "avature": _s('<div><article class="article article--result"><h3 class="x"><a href="https://acme.avature.net/careers/JobDetail/role/@I">@T</a></h3><span class="list-item-location">@C</span></article></div>', "https://acme.avature.net/careers/JobDetail/role/@I"),
    "bamboohr": _s('<ul><li id="bhrPositionID_@I" class="BambooHR-ATS-Jobs-Item"><a href="//acme.bamboohr.com/jobs/view.php?id=@I">@T</a><span class="BambooHR-ATS-Location">@C</span></li></ul>', "https://acme.bamboohr.com/jobs/view.php?id=@I"),
    "beisen": _s('{"Code":200,"Data":[{"JobAdId":"@I","JobAdName":"@T","LocNames":["@C"],"Org":"Lab","Salary":"10k-20k","Duty":"Build","Require":"Know","PostDate":"2026-04-01"}],"Count":1}', "https://acme.zhiye.com/portal/jobs/@I", department="Lab", description="Build\n\nKnow"),
    "beisen_legacy": _s('<table class="jobsTable"><tr><th>h</th></tr><tr><td><a href="/zpdetail/@I">@T</a></td><td>Sales</td><td>@C</td><td>2026-04-02</td></tr></table>', "https://acme.zhiye.com/zpdetail/@I", department="Sales", posted_at="2026-04-02 00:00:00"),
    "breezy": _s('[{"id":"@I","name":"@T","url":"https://acme.breezy.hr/p/@I","location":{"name":"@C","is_remote":true},"type":{"id":"fullTime","name":"Full-Time"},"company":{"name":"Acme Co"},"published_date":"2026-03-01T00:00:00.000Z"}]', "https://acme.breezy.hr/p/@I", is_remote="true", company="Acme Co"),
    "builtin": _s(_LD % '{"@graph":[{"@type":"WebPage"},{"@type":"ItemList","itemListElement":[{"url":"https://builtin.com/job/some-role/@I","name":"@T","description":"d"}]}]}', "https://builtin.com/job/some-role/@I", None, description="d"),
    "bundesagentur": _s('{"stellenangebote":[{"refnr":"@I","titel":"@T","arbeitgeber":"Werk GmbH","arbeitsort":{"ort":"@C"},"arbeitszeit":"vz","aktuelleVeroeffentlichungsdatum":"2026-05-01","hashId":"h9"}]}', "https://www.arbeitsagentur.de/jobsuche/jobdetail/@I", company="Werk GmbH", requisition_id="h9"),
    "bytedance": _s('{"data":{"job_post_list":[{"id":"@I","title":"@T","city_info":{"en_name":"@C"},"job_category":{"en_name":"R&D"},"description":"a","requirement":"b","job_post_info":{"min_salary":"100","max_salary":0,"currency":"USD"},"publish_time":1767225600000}]}}', "https://joinbytedance.com/search/@I", department="R&D", salary_min="100.0", posted_at="2026-01-01 00:00:00"),
    "cornerstone": _s('{"data":{"requisitions":[{"requisitionId":@I,"displayJobTitle":"@T","locations":[{"city":"@C"}],"postingEffectiveDate":"3/7/2026","schedule":"Day"}],"totalCount":1}}', "https://acme.csod.com/ux/ats/careersite/1/job/@I?c=acme", commitment="Day", posted_at="2026-03-07 00:00:00"),
    "darwinbox": _s('{"status":1,"data":[{"id":"@I","designation_display_name":"@T","officelocation_show_arr":"@C","department_name":"Ops","emp_type_name":"Permanent","is_remote":0}]}', "https://acme.darwinbox.in/ms/candidate/careers/@I", department="Ops", is_remote="false"),
    "dayforce": _s('[{"ReferenceNumber":@I,"Title":"@T","JobDetailsUrl":"https://jobs.dayforcehcm.com/en-US/acme/c/jobs/@I","City":"@C","CompanyName":"Acme Ltd","EmploymentIndicator":"Full time","DatePosted":"2026-02-02T00:00:00"}]', "https://jobs.dayforcehcm.com/en-US/acme/c/jobs/@I", company="Acme Ltd", commitment="Full time"),
    "eightfold": _s('{"positions":[{"id":@I,"name":"@T","locations":["@C"],"department":"Eng","t_create":1767225600}],"count":1}', "https://acme.eightfold.ai/careers/job/@I", department="Eng", posted_at="2026-01-01 00:00:00"),
    "eures": _s('{"jvs":[{"id":"@I","title":"@T","employerName":"Firma","locationMap":{"@C":["DE3"]},"creationDate":1767225600000,"positionScheduleCode":"fulltime"}]}', "https://europa.eu/eures/portal/jv-se/jv-details/@I?lang=en", "@C (DE3)", company="Firma", commitment="fulltime"),
    "gem": _s('{"data":{"oatsExternalJobPostings":{"jobPostings":[{"extId":"@I","title":"@T","locations":[{"city":"@C","isRemote":false},{"city":"Oslo","isoCountry":"NO","isRemote":true}],"job":{"employmentType":"FULL_TIME","department":{"name":"Eng"}}}]}}}', "https://jobs.gem.com/acme/@I", "@C; Oslo, NO", is_remote="true", department="Eng"),
    "getonbrd": _s('{"data":[{"id":"@I","attributes":{"title":"@T","remote":false,"countries":["@C"],"min_salary":2000,"max_salary":3000,"published_at":1767225600,"category_name":"Data"},"links":{"public_url":"https://gob.example/@I"}}]}', "https://gob.example/@I", salary_max="3000.0", salary_period="MONTH", is_remote="false"),
    "google": _s('<ul><li class="r"><h3>@T</h3><i class="m">corporate_fare</i><span>Google</span><i class="m">place</i><span>@C</span><a aria-label="x" href="./jobs/results/@I-role?q=1">go</a></li></ul>', "https://www.google.com/about/careers/applications/jobs/results/@I", company="Google"),
    "greenhouse": _s('{"jobs":[{"id":@I,"title":"@T","absolute_url":"https://boards.greenhouse.io/acme/jobs/@I","location":{"name":"@C"},"departments":[{"name":"Eng"}],"requisition_id":"TBD","pay_input_ranges":[{"min_cents":9000000,"max_cents":12000000,"currency_type":"usd"},{"min_cents":8000000,"max_cents":0,"currency_type":"USD"},{"min_cents":100,"max_cents":200,"currency_type":"CAD"}],"first_published":"2026-01-02T03:04:05-05:00"}]}', "https://boards.greenhouse.io/acme/jobs/@I", department="Eng", salary_min="80000.0", salary_max="120000.0", salary_currency="USD", posted_at="2026-01-02 08:04:05"),
    "gupy": _s('<script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"jobs":[{"id":@I,"title":"@T","workplace":{"workplaceType":"on-site","address":{"city":"@C"}},"type":"vacancy_type_effective"}]}}}</script>', "https://acme.gupy.io/jobs/@I", is_remote="false"),
    "herp": _s('<ul><li class="requisition-list-card"><a href="/v1/acme/@I"><h2 class="requisition-list-card__title">@T</h2></a><span class="career-page-group-name-tag__text">Dev</span></li></ul>', "https://herp.careers/v1/acme/@I", None, department="Dev"),
    "hrmos": _s('<ul><li class="pg-list-cassette"><a href="https://hrmos.co/pages/acme/jobs/@I"><h2>@T</h2></a><span class="sg-tag-location">@C</span><div class="pg-list-cassette-body">text</div></li></ul>', "https://hrmos.co/pages/acme/jobs/@I", description="text"),
    "icims": _s('<ul><li class="iCIMS_JobCardItem"><a href="https://careers-acme.icims.com/jobs/@I/role/job?in_iframe=1" class="iCIMS_Anchor"><h3>@T</h3></a><span class="sr-only field-label">Job Locations</span><span>@C</span><span title="3/9/2026 10:15 AM">ago</span></li></ul>', "https://careers-acme.icims.com/jobs/@I/role/job?in_iframe=1", posted_at="2026-03-09 00:00:00"),
    "infojobs_es": _s('{"offers":[{"code":"@I","title":"@T","link":"//www.infojobs.net/of-i@I","companyName":"Casa","city":"@C","contractType":"indefinido","publishedAt":"2026-04-04T09:00:00Z"}]}', "https://www.infojobs.net/of-i@I", company="Casa", commitment="indefinido"),
    "jazzhr": _s('<table><tr id="row_job_20260101"><td><a class="job_title_link" href="/apply/jobs/details/@I?&">@T</a><span class="resumator_department">Ops</span></td><td>@C</td></tr></table>', "https://acme.applytojob.com/apply/jobs/details/@I", department="Ops"),
    "jobbankca": _s('<article id="article-@I" class="a"><a class="resultJobItem" href="/jobsearch/jobposting/@I"><span class="noctitle">@T</span><ul><li class="date">May 05, 2026</li><li class="business">Mill</li><li class="location">@C</li><li class="salary">$20 hourly</li></ul></a></article>', "https://www.jobbank.gc.ca/jobsearch/jobposting/@I", company="Mill", salary_summary="$20 hourly", posted_at="2026-05-05 00:00:00"),
    "jobs_cz": _s('<article class="SearchResultCard"><h2><a data-jobad-id="@I" href="https://www.jobs.cz/rpd/@I/">@T</a></h2><span translate="no">Firma</span><ul><li data-test="serp-locality">@C</li></ul></article>', "https://www.jobs.cz/rpd/@I/", company="Firma"),
    "jobsch": _s('{"documents":[{"job_id":"@I","title":"@T","company_name":"Bahn","place":"@C","_links":{"detail_de":{"href":"https://www.jobs.ch/de/@I"}},"publication_date":"2026-03-03T00:00:00+01:00"}]}', "https://www.jobs.ch/de/@I", company="Bahn", posted_at="2026-03-02 23:00:00"),
    "jobvite": _s('<table class="jv-job-list"><tr><td class="jv-job-list-name"><a href="/acme/job/@I">@T</a></td><td class="jv-job-list-location">@C</td></tr></table>', "https://jobs.jobvite.com/acme/job/@I"),
    "join_com": _s('{"items":[{"id":@I,"idParam":"@I-role","title":"@T","city":{"cityName":"@C"},"employmentType":{"name":"Employee"},"createdAt":"2026-02-03T00:00:00Z"}]}', "https://join.com/companies/acme/@I-role", commitment="Employee"),
    "keka": _s('[{"id":"@I","title":"@T","jobLocations":[{"city":"@C"}],"departmentName":"QA","salaryRange":{"minimum":5,"maximum":9,"currency":"INR"},"publishedOn":"2026-02-04"}]', "https://acme.keka.com/careers/jobdetails/@I", department="QA", salary_max="9.0"),
    "lever": _s('[{"id":"@I","text":"@T","hostedUrl":"https://jobs.lever.co/acme/@I","categories":{"location":"@C","team":"Core","commitment":"Full-time"},"description":"<p>a</p>","lists":[{"text":"Needs","content":"<li>b</li>"}],"workplaceType":"remote","salaryRange":{"min":50000,"max":70000,"currency":"EUR","interval":"per-year-salary"},"createdAt":1767225600000}]', "https://jobs.lever.co/acme/@I", team="Core", is_remote="true", salary_period="YEAR", posted_at="2026-01-01 00:00:00", description="<p>a</p>\n\nNeeds\n<li>b</li>"),
    "manfred": _s('[{"slug":"x","position":"gone","status":"CLOSED"},{"slug":"@I","position":"@T","status":"ACTIVE","company":{"name":"Uno"},"locations":["@C"],"salaryFrom":30000,"salaryTo":40000,"currency":"€"}]', "https://www.getmanfred.com/job-offers/@I", salary_currency="EUR", company="Uno"),
    "mercor": _s('{"listings":[{"listingId":"@I","title":"@T","companyName":"Mercator","location":"@C","rateMin":20,"rateMax":30,"workArrangement":"Remote","postedAt":"2026-02-02T02:02:02Z"}]}', "https://work.mercor.com/jobs/@I", salary_currency="USD", is_remote="true", company="Mercator"),
    "meta": _s('{"data":{"job_search_with_featured_jobs":{"all_jobs":[{"id":"@I","title":"@T","locations":["@C","Paris"],"teams":["AI"],"sub_teams":["Vision"]}]}}}', "https://www.metacareers.com/jobs/@I/", "@C; Paris", team="AI", department="Vision"),
    "moka": _s('{"jobs":[{"id":"@I","title":"@T","locations":[{"cityName":"@C"}],"department":{"name":"Art"},"publishedAt":"2026-03-05T00:00:00Z"}],"jobStats":{"total":1}}', "https://app.mokahr.com/social-recruitment/acme#/job/@I", department="Art"),
    "oracle": _s('{"items":[{"TotalJobsCount":1,"requisitionList":[{"Id":"@I","Title":"@T","PrimaryLocation":"@C","WorkplaceTypeCode":"ORA_ON_SITE","PostedDate":"2026-03-06","JobFamily":"Ops"}]}]}', "https://acme/hcmUI/CandidateExperience/en/job/@I", is_remote="false", team="Ops"),
    "pageup": _s('<table><tbody id="search-results-content"><tr><td><a class="job-link" href="/999/cw/en/job/@I/role">@T</a></td><td><span class="location">@C</span></td><td><span class="work-type">Casual</span></td></tr></tbody></table>', "https://careers.pageuppeople.com/999/cw/en/job/@I/role", commitment="Casual"),
    "paycom": _s('{"jobPostingPreviews":[{"jobId":@I,"jobTitle":"@T","locations":"@C","positionType":"Full Time","remoteType":"Remote","postedOn":"2/3/2026"}],"jobPostingPreviewsCount":1}', "https://www.paycomonline.net/v4/ats/web.php/portal/acme/jobs/@I", is_remote="true", posted_at="2026-02-03 00:00:00"),
    "paylocity": _s('<script>window.pageData = {"Jobs":[{"JobId":1,"JobTitle":"in","IsInternal":true},{"JobId":@I,"JobTitle":"@T","LocationName":"@C","HiringDepartment":"HR","PublishedDate":"2026-02-05T00:00:00","IsInternal":false}]};</script>', "https://recruiting.paylocity.com/Recruiting/Jobs/Details/@I", department="HR"),
    "personio": _s('{"data":[{"id":@I,"name":"@T","office":"@C","department":"Legal","schedule":"full-time","createdAt":"2026-01-09T00:00:00+00:00"}]}', "https://acme.jobs.personio.de/job/@I", department="Legal", commitment="full-time"),
    "phenom": _s('{"refineSearch":{"data":{"jobs":[{"jobId":"@I","title":"@T","cityState":"@C","category":"IT","jobSeqNo":"S1","postedDate":"2026-03-08T00:00:00.000+0000"}]}}}', "https://acme/job/@I", department="IT", requisition_id="S1"),
    "pinpoint": _s('{"data":[{"id":"@I","title":"@T","url":"https://acme.pinpointhq.com/@I","location":{"name":"@C"},"workplace_type":"onsite","compensation_visible":false,"compensation_minimum":1,"job":{"department":{"name":"Fin"}}}]}', "https://acme.pinpointhq.com/@I", is_remote="false", department="Fin"),
    "programathor": _s('<div class="cell-list "><a href="/jobs/@I-role"><h3>@T<span class="n">NOVA</span></h3><i class="fa fa-briefcase"></i>Loja <i class="fas fa-map-marker-alt"></i>@C<i class="far fa-money-bill-alt"></i>R$5.000</a></div>', "https://programathor.com.br/jobs/@I-role", company="Loja", salary_summary="R$5.000"),
    "recruitee": _s('{"offers":[{"id":@I,"slug":"role","title":"@T","careers_url":"https://acme.recruitee.com/o/@I","location":"@C","remote":true,"department":"PM","description":"a","requirements":"b","created_at":"2026-01-10 11:12:13 UTC"}]}', "https://acme.recruitee.com/o/@I", is_remote="true", posted_at="2026-01-10 11:12:13", description="a\n\nb"),
    "recruiterbox": _s('{"objects":[{"id":"@I","title":"@T","hosted_url":"https://acme.recruiterbox.com/jobs/@I","location":{"city":"@C"},"allows_remote":false,"team":"Blue","position_type":"full_time"}],"meta":{}}', "https://acme.recruiterbox.com/jobs/@I", team="Blue", is_remote="false"),
    "remoteok": _s('[{"legal":"note"},{"id":"@I","position":"@T","company":"Co","url":"https://remoteok.example/@I","location":"@C","salary_min":1000,"salary_max":0,"epoch":1767225600}]', "https://remoteok.example/@I", salary_min="1000.0", salary_currency="USD", company="Co", posted_at="2026-01-01 00:00:00"),
    "rippling": _s('{"items":[{"uuid":"@I","name":"@T","workLocation":{"label":"@C"},"department":{"id":"d","label":"Sales"}}]}', "https://ats.rippling.com/acme/jobs/@I", department="Sales"),
    "seek": _s('{"data":[{"id":"@I","title":"@T","advertiser":{"description":"Shop"},"locations":[{"label":"@C","countryCode":"AU"}],"classifications":[{"classification":{"description":"Retail"}}],"workTypes":["Full time"],"salaryLabel":"$30 per hour","listingDate":"2026-04-06T00:00:00Z"}],"totalCount":1}', "https://www.seek.com.au/job/@I", company="Shop", department="Retail", salary_summary="$30 per hour"),
    "smartrecruiters": _s('{"content":[{"id":"@I","name":"@T","location":{"city":"@C","remote":false},"department":{"label":"Ops"},"typeOfEmployment":{"label":"Permanent"},"refNumber":"REF9","releasedDate":"2026-03-10T00:00:00.000Z"}]}', "https://jobs.smartrecruiters.com/acme/@I", requisition_id="REF9", is_remote="false"),
    "softgarden": _s('{"numberOfItems":1,"dataFeedElement":[{"dateModified":"x","item":{"identifier":{"value":"@I"},"title":"@T","url":"https://acme.softgarden.io/job/@I","hiringOrganization":{"name":"Werft"},"jobLocation":{"address":{"addressLocality":"@C"}},"datePosted":"2026-02-06"}}]}', "https://acme.softgarden.io/job/@I", company="Werft"),
    "successfactors": _s('<rss xmlns:g="http://base.google.com/ns/1.0"><channel><title>c</title><item><title>@T</title><link>https://jobs.acme.example/@I</link><g:id>@I</g:id><g:location>@C</g:location><g:employer>Acme SE</g:employer><pubDate>Tue, 05 May 2026 08:00:00 +0200</pubDate></item></channel></rss>', "https://jobs.acme.example/@I", company="Acme SE", posted_at="2026-05-05 06:00:00"),
    "taleo": _s('<a class="viewJobLink" href="https://acme.taleo.net/x/viewRequisition?org=ACME&cws=1&rid=@I">@T</a>', "https://acme.taleo.net/x/viewRequisition?org=ACME&cws=1&rid=@I", None),
    "teamtailor": _s('<rss><channel><item><title>@T</title><link>https://acme.teamtailor.com/jobs/@I</link><guid>@I</guid><tt:locations xmlns:tt="u"><tt:location><tt:city>@C</tt:city></tt:location></tt:locations><remoteStatus>none</remoteStatus><pubDate>Mon, 02 Mar 2026 10:00:00 +0000</pubDate></item></channel></rss>', "https://acme.teamtailor.com/jobs/@I", is_remote="false", posted_at="2026-03-02 10:00:00"),
    "tesla": _s('{"lookup":{"locations":{"7":"@C"},"departments":{"3":"Cells"}},"listings":[{"id":"@I","t":"@T","l":"7","d":"3"}]}', "https://www.tesla.com/careers/search/job/@I", department="Cells"),
    "thehub": _s('{"docs":[{"id":"old","title":"o","status":"CLOSED"},{"id":"@I","title":"@T","status":"ACTIVE","company":{"name":"Start"},"location":{"address":"@C"},"isRemote":false,"salaryRange":{"from":10,"to":20,"currency":"DKK"}}]}', "https://thehub.io/jobs/@I", company="Start", salary_currency="DKK"),
    "tiktok": _s('{"data":{"job_post_list":[{"id":"@I","title":"@T","city_info":{"name":"@C"},"recruit_type":{"en_name":"Regular"},"code":"A9"}],"count":1}}', "https://lifeattiktok.com/search/@I", commitment="Regular", requisition_id="A9"),
    "uber": _s('{"data":{"results":[{"id":@I,"title":"@T","allLocations":[{"city":"@C","countryName":"India"}],"team":"Maps","timeType":"Full-Time","creationDate":"2026-02-07T00:00:00.000Z"}],"totalResults":{"low":1}}}', "https://www.uber.com/global/en/careers/list/@I/", "@C, India", team="Maps"),
    "ukg": _s('{"opportunities":[{"Id":"@I","Title":"@T","Locations":[{"Address":{"City":"@C"}}],"FullTime":true,"JobCategoryName":"Care","RequisitionNumber":"N1","PostedDate":"2026-02-08T00:00:00Z"}],"totalCount":1}', "https://recruiting.ultipro.com/acme/OpportunityDetail?opportunityId=@I", commitment="Full time", department="Care"),
    "usajobs": _s('{"SearchResult":{"SearchResultItems":[{"MatchedObjectId":"9","MatchedObjectDescriptor":{"PositionID":"@I","PositionTitle":"@T","PositionURI":"https://www.usajobs.gov/job/@I","PositionLocation":[{"LocationName":"@C"}],"OrganizationName":"Park Service","PositionRemuneration":[{"MinimumRange":"40000","MaximumRange":"50000","RateIntervalCode":"PA"}]}}]}}', "https://www.usajobs.gov/job/@I", company="Park Service", salary_min="40000.0"),
    "wanted": _s('{"data":[{"id":@I,"position":"@T","company":{"name":"Hana"},"address":{"location":"@C"}}],"links":{}}', "https://www.wanted.co.kr/wd/@I", company="Hana"),
    "welcometothejungle": _s('{"hits":[{"reference":"@I","name":"@T","slug":"role-@I","organization":{"name":"Org","reference":"org"},"offices":[{"city":"@C"}],"remote":"fulltime","contract_type":"full_time","salary_yearly_minimum":30000}]}', "https://www.welcometothejungle.com/en/companies/org/jobs/role-@I", company="Org", is_remote="true", salary_min="30000.0"),
    "wellfound": _s('[**Firm**](https://wellfound.com/company/firm)\n[@T](https://wellfound.com/jobs/@I-role)\nRemote', "https://wellfound.com/jobs/@I-role", None),
    "weworkremotely": _s('<rss><channel><item><guid>@I</guid><title>@T</title><link>https://wwr.example/@I</link><country>@C</country><category>Dev</category><type>Full-Time</type><pubDate>Mon, 02 Mar 2026 10:00:00 +0000</pubDate></item></channel></rss>', "https://wwr.example/@I", department="Dev", commitment="Full-Time"),
    "workable": _s('{"jobs":[{"shortcode":"@I","title":"@T","url":"https://apply.workable.com/j/@I","locations":[{"city":"@C","country":"Greece"}],"telecommuting":false,"type":"Full-time","published_on":"2026-02-09"}]}', "https://apply.workable.com/j/@I", "@C, Greece", is_remote="false", posted_at="2026-02-09 00:00:00"),
    "workday": _s('{"total":1,"jobPostings":[{"title":"@T","externalPath":"/job/Town/Role_@I","locationsText":"@C","bulletFields":["@I"],"timeType":"Full time","remoteType":"Fully Remote"}]}', "https://acme/job/Town/Role_@I", is_remote="true", commitment="Full time"),
    "ycombinator": _s('<div data-page="x">{"a":1,"jobPostings":[{"id":@I,"title":"@T","url":"/companies/acme/jobs/@I","location":"@C","type":"Full-time","salaryRange":"$1K - $2K"}],"b":2}</div>', "https://www.ycombinator.com/companies/acme/jobs/@I", salary_summary="$1K - $2K", commitment="Full-time"),
}
