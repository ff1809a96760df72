"""Where each board keeps its fields. Fixed values, one selector per field."""

RULES = {
    "monster_sg": {
        "title": "div.job-tittle.detail-job-tittle h1::text",
        "employer": "div.job-tittle.detail-job-tittle span *::text",
        "location": "span.loc::text",
        "experience": "span.exp::text",
        "salary": "span.package::text",
        "employment_type": "span.color-grey-light::text",
        "posted": ".pLR-10:nth-child(1)::text",
        "badge_3": ".pLR-10:nth-child(3)::text",
        "badge_4": ".pLR-10:nth-child(4)::text",
        "description_1": "div.job-description-content p.jd-text::text",
        "description_2": "div.job-description-content li::text",
        "description_3": "div.job-description-content p div::text",
        "description_4": "div.job-description-content span::text",
        "description_5": "div.job-description-content div::text",
        "detail": ".job-detail-list",
        "detail_key": ".dt-heading *::text",
        "detail_value": ".dt-content *::text",
    },
    "careerjet": {
        "title": "#job > div > header > h1::text",
        "employer": "#job > div > header > p::text",
        "detail": "#job > div > header > ul.details > li",
        "apply": "#job > div > section.nav > ul > li.col.col-xs-8.col-m-6 > a::attr(href)",
        "posted": "#job > div > header > ul.tags > li:nth-child(1) > span::text",
        "description": "#job > div > section.content",
    },
    "paypal": {
        "title": "#jdp-title-job-title::text",
        "block": "#jdp-job-snapshot-section > div > ul > li *::text",
        "description": "#jdp-job-description-section > div *::text",
    },
    "quest": {
        "snapshot": "#jdp-job-snapshot-section > div > ul > li *::text",
        "location": "#jdp-job-snapshot-section > div > ul > li.job-location > div > a > span *::text",
        "industry": "#jdp-job-snapshot-section > div > ul > li.job-categories > div > div > a *::text",
        "title": "#jdp-title-job-title > span.jdp-title-job-title *::text",
        "description": "#jdp-job-description-section > div *::text",
    },
    "lockheed": {
        "title": "#anchor-responsibilties > p.ajd_job-details__job-title *::text",
        "location": "#anchor-responsibilties > p.ajd_job-details__location *::text",
        "job_id": "#anchor-responsibilties > div > span.job-id.job-info *::text",
        "industry": "#anchor-responsibilties > div > span.job-contact-name *::text",
        "posted": "#anchor-responsibilties > div > span.job-date.job-info *::text",
        "description": "#anchor-responsibilties *::text",
        "apply": "#anchor-responsibilties > a::attr(href)",
    },
    "cisco": {
        "title": "h2",
        "location": ".fields-data_value",
        "job_id": (
            "#content > div > div:nth-of-type(2) > div > div:nth-of-type(2) > div:nth-of-type(2)"
            " > div > div > ul > li:nth-of-type(5) > div:nth-of-type(2)"
        ),
        "industry": (
            "#content > div > div:nth-of-type(2) > div > div:nth-of-type(2) > div:nth-of-type(2)"
            " > div > div > ul > li:nth-of-type(2) > div:nth-of-type(2)"
        ),
        "description": ".job_description",
    },
    "riteaid": {
        "location": ".job-locations-wrap.meta-data-option",
        "description": ".main-description-body",
        "apply": "#link-apply::attr(href)",
    },
    "mckesson": {
        "item": "#wd-PageContent-vbox > div:nth-of-type(1) li",
    },
}

LISTING_RULES = {
    "monster_sg": {
        "total": "span.main-heading::text",
        "card": "[class*=job-apply-card]",
        "sponsored": "span.sponsr::text",
        "link": "div.job-tittle a::attr(href)",
    },
    "careerjet": {
        "links": "#search-content > ul.jobs > li *::attr(href)",
        "next": "#search-content > p > a::attr(href)",
    },
    "paypal": {"links": "#job-result-table > tbody > tr *::attr(href)"},
    "quest": {"links": ".job-result-title::attr(href)"},
    "lockheed": {"links": "#search-results-list > ul > li *::attr(href)"},
    "cisco": {"links": "a::attr(href)"},
    "riteaid": {
        "card": (
            "div.job-results-container > search-job-cards > mat-accordion"
            " > mat-expansion-panel.mat-expansion-panel"
        ),
        "industry": ".categories.label-value",
        "anchor": "a",
        "link": "a::attr(href)",
    },
}

# Which links of a listing page are postings, what they are put behind,
# and the positions of fields in text lists.
LINK_SLICES = {"paypal": (4, None), "cisco": (14, 26)}
LINK_BASES = {
    "careerjet": "https://www.careerjet.co.in/",
    "paypal": "https://jobsearch.paypal-corp.com/",
    "quest": "https://careers.questdiagnostics.com/",
    "lockheed": "https://www.lockheedmartinjobs.com/",
    "mckesson": "https://mckesson.wd3.myworkdayjobs.com/",
    "marriott": "https://jobs.marriott.com/marriott/jobs/",
    "cisco": "https://jobs.cisco.com/",
    "riteaid": "https://careers.riteaid.com/",
    "monster_sg": "https://www.monster.com.sg/",
}
POSITIONS = {
    "paypal": {
        "employment_type": 5,
        "location": 15,
        "industry": 24,
        "experience": 32,
        "posted": 40,
        "job_id": 48,
    },
    "quest": {"employment_type": 5, "job_id": -3, "posted": -11},
    "mckesson": {"title": 0, "location": 1, "job_id": -1, "employment_type": -2, "posted": -3},
}
DESCRIPTION_CUTS = {"paypal": (2, 3), "quest": (2, 1), "lockheed": (0, 12)}
MIN_DESCRIPTION = 200
# Where each board's listing ends (page limit and number of links, applied
# only by callers that pass them on; or the first page without links) and the attempts
# allowed per kind of request.
PAGE_LIMITS = {"monster_sg": 20, "careerjet": 100, "mckesson": 18}
LINK_CAPS = {"paypal": 10_000, "quest": 10_000, "lockheed": 10_000}
UNTIL_EMPTY = ("riteaid", "cisco", "marriott")
ATTEMPTS = {"start": 5, "start_capped": 10, "listing": 5, "detail": 15}
# Domains each board's requests stay on, sub-domains included.
DOMAINS = {
    "paypal": ["jobsearch.paypal-corp.com"],
    "quest": ["careers.questdiagnostics.com"],
    "lockheed": ["lockheedmartinjobs.com"],
    "careerjet": ["careerjet.co.in"],
    "monster_sg": ["monster.com.sg"],
    "marriott": ["jobs.marriott.com"],
}
