"""Listing and detail pages in each board's layout, written by Spark SQL expressions from
the given tables. Layouts are our own, made from the field rules; no captured page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.catalog.registry import spread_table


def monster_listings(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.lit("monster_sg").alias("source"),
        F.col("o_orderkey").alias("page_no"),
        F.expr(
            """concat('<html><body><span class="main-heading">Showing jobs of ', o_orderkey, '</span><div class="list">',
            '<div class="card-panel job-apply-card"><div class="job-tittle"><h3><a href="//www.monster.com.sg/job/', o_custkey,
            '">One</a></h3></div></div>',
            '<div class="card-panel job-apply-card">', if(o_orderstatus = 'P', '<span class="sponsr">Ad</span>', ''),
            '<div class="job-tittle"><a href="//www.monster.com.sg/job/', o_orderkey, '">Two</a></div></div></div></body></html>')"""
        ).alias("html"),
    )


LISTING_HTML = {
    "careerjet": """concat('<div id="search-content"><ul class="jobs"><li><a href="/job/', p_partkey,
        '">J</a><p><a href="company/', p_size, '">C</a></p></li></ul><p><a href="/?p=1">1</a><a href="/?p=2">Next</a></p></div>')""",
    "paypal": """concat('<table id="job-result-table"><tbody><tr><td><a href="/s1">1</a><td><a href="/s2">2</a>',
        '<td><a href="/s3">3</a><td><a href="/s4">4</a><tr><td><a href="/en-US/job/', p_partkey, '">J</a>',
        '<tr><td><a href="en-US/job/x', p_size, '">J</a></tbody></table><a href="/no">no</a>')""",
    "quest": """concat('<div><a class="job-result-title big" href="/en-US/job/', p_partkey, '">J</a><a href="/no">no</a></div>')""",
    "lockheed": """concat('<section id="search-results-list"><ul><li><a href="/job/', p_partkey,
        '"><h2>J</h2></a></ul></section><a href="/no">no</a>')""",
    "cisco": """concat('<div>', array_join(transform(sequence(0, 29),
        i -> concat('<a href="/jobs/', p_partkey, '/', i, '">', i, '</a>')), ''), '</div>')""",
}

# Detail pages by board: (table, url, html).
DETAIL_HTML = {
    "monster_sg": (
        "part",
        "concat('https://www.monster.com.sg/job/', p_partkey)",
        """concat('<div class="job-tittle detail-job-tittle"><h1>\n ', p_name, ' </h1><span><a href="/c"> ', p_brand, '\n</a></span></div>',
        '<span class="loc"> ', p_type, ' </span><span class="exp">', if(p_partkey % 4 = 0, 'Fresher', concat(p_size, '-', p_size + 3, ' years')), '</span>',
        '<span class="package">', if(p_partkey % 3 = 0, 'Not Specified', concat(p_size, ',000-', p_size + 9, ',000')), '</span>',
        '<span class="color-grey-light">', if(p_size > 25, 'Permanent Job', 'Contract'), '</span>',
        '<div><span class="pLR-10">Posted: ', p_size, ' days ago</span><span class="x">|</span><span class="pLR-10">Ref: ', p_partkey, '</span>',
        if(p_partkey % 2 = 0, concat('<span class="pLR-10">Job Id: ', p_partkey + 7, '</span>'), ''), '</div>',
        '<div class="job-description-content">', case p_partkey % 4 when 0 then concat('<p class="jd-text">Do ', p_name, '<p class="jd-text"> &amp; more')
          when 1 then concat('<ul><li>', p_name, '<li>', p_type, '</ul>') when 2 then concat('<div>', p_name, '</div>') else '' end, '</div>',
        '<div class="job-detail-list"><div class="dt-heading"><b>Skills</b></div><div class="dt-content"><a>', p_name, '&nbsp;1</a> <a>', p_brand, '</a></div></div>',
        '<div class="job-detail-list"><div class="dt-heading"><b>Industry</b></div><div class="dt-content"><a>\n', p_type, ' </a></div></div>',
        if(p_partkey % 5 = 0, concat('<div class="job-detail-list"><div class="dt-heading"><b>Function</b></div><div class="dt-content"><a>', p_brand, '</a></div></div>'), ''))""",
    ),
    "careerjet": (
        "part",
        "concat('https://www.careerjet.co.in/job/', p_partkey)",
        """concat('<div id="job"><div><header><h1>', p_name, '</h1><p> ', p_brand, ' </p><ul class="details"><li><svg class="i"><use/></svg> ', p_type,
        '</li>', if(p_partkey % 2 = 0, concat('<li><svg><use></use></svg><span> ', p_size, ',000 - ', p_size + 9, ',000 INR </span></li>'), ''),
        '<li><svg><use/></svg>Permanent</li><li><svg><use/></svg> Full time </li></ul><ul class="tags"><li><span>', p_size, ' days ago</span></li></ul></header>',
        '<section class="nav"><ul><li class="col col-xs-8 col-m-6"><a href="/apply/', p_partkey, '">Apply</a></li></ul></section>',
        '<section class="content">[Make ', p_name, '<br>and\n', p_type, ' &amp; co<script>no()</script>]</section></div></div>')""",
    ),
    "paypal": (
        "part",
        "concat('https://jobsearch.paypal-corp.com/job/', p_partkey)",
        """concat('<h1 id="jdp-title-job-title"> ', p_name, ' </h1><section id="jdp-job-snapshot-section"><div><ul><li>',
        array_join(transform(sequence(0, 48), i -> concat('<i>', case i when 5 then ' Full time ' when 15 then p_type when 24 then p_brand
          when 32 then if(p_partkey % 3 = 0, 'Not Specified', concat(p_size, '-', p_size + 2, ' years')) when 40 then concat('12/', 1 + p_size % 28, '/2021')
          when 48 then if(p_partkey % 7 = 0, ' ', concat('R', p_partkey)) else 'x' end, '</i>')), ''),
        '</li></ul></div></section><section id="jdp-job-description-section"><div><b>a</b><b>b</b><p>Run\t', p_name, '&nbsp;</p><p> fast\r\n</p><i>x</i><i>y</i><i>z</i></div></section>')""",
    ),
    "quest": (
        "part",
        "concat('https://careers.questdiagnostics.com/job/', p_partkey)",
        """concat('<div id="jdp-title-job-title"><span class="jdp-title-job-title"><b>Co-op ', p_name, ' - ', p_type, ' (US)</b></span></div>',
        '<section id="jdp-job-snapshot-section"><div><ul><li>', array_join(transform(sequence(0, 7), i -> concat('<i>', if(i = 5, 'Part time', 'x'), '</i>')), ''),
        '</li><li class="job-location"><div><a><span><b>', p_type, ' (US)</b></span></a></div></li>',
        '<li class="job-categories"><div><div><a><b>', p_brand, '</b></a></div></div></li><li><i>', concat(1 + p_size % 12, '/', 1 + p_size % 28, '/2021'), '</i>',
        array_join(transform(sequence(0, 6), i -> '<i>y</i>'), ''), '<i>J', p_partkey, '</i><i>p</i><i>q</i></li></ul></div></section>',
        '<section id="jdp-job-description-section"><div><b>a</b><b>b</b><p>Test\n ', p_name, '</p><p>&nbsp;now</p><i>z</i></div></section>')""",
    ),
    "lockheed": (
        "part",
        "concat('https://www.lockheedmartinjobs.com/job/', p_partkey)",
        """concat('<div id="anchor-responsibilties"><p class="ajd_job-details__job-title"><b>', p_name, '</b></p><p class="ajd_job-details__location"><b>', p_type,
        '</b></p><div><span class="job-id job-info"><b>Job ID:</b> <i>', p_partkey, 'BR</i></span>',
        if(p_partkey % 4 = 0, '', concat('<span class="job-contact-name"><b>', p_brand, '</b><b>Space</b></span>')),
        '<span class="job-date job-info"><b>Date</b><b>', concat(1 + p_size % 12, '/', 1 + p_size % 28, '/2021'), '</b></span></div>',
        '<div><i>Build ', p_name, '\r\n</i>', array_join(transform(sequence(1, 11), i -> '<i>t</i>'), ''), '</div><a href="https://apply.example.com/', p_partkey, '">Apply</a></div>')""",
    ),
    "cisco": (
        "part",
        "concat('https://jobs.cisco.com/jobs/', p_partkey)",
        """concat('<h2> ', p_name, ' <i>lead</i></h2><div class="job_description"><p>Keep ', p_name, '</p><p>well</p></div><div id="content"><p>n</p><div><div>1</div><p>s</p><div><div><div>1</div><div>',
        '<div>1</div><div><div><div><ul><li>1</li><li><div>Area</div><div>', p_brand, '</div></li><li>3</li><li>4</li><li><div>Id</div><div> ', p_partkey,
        '</div></li></ul></div></div></div></div></div></div></div></div><span class="fields-data_value">', p_type, '</span><span class="fields-data_value">no</span>')""",
    ),
    "mckesson": (
        "part",
        "concat('https://mckesson.wd3.myworkdayjobs.com/job/', p_partkey)",
        """concat('<div id="wd-PageContent-vbox"><div><ul><li>', p_name, '<li>', p_type, '<li>', p_name, '<li><li><p>', repeat('Move goods. ', 20), p_brand, '</p>',
        '<li>Posted ', p_size, '+ Days Ago<li>Full time<li>JR', p_partkey, '<li>Apply<li>Share</ul></div><div><ul><li>other</ul></div></div>')""",
    ),
    "riteaid": (
        "orders",
        "concat('https://careers.riteaid.com/jobs/', o_orderkey)",
        """concat('<div class="job-locations-wrap meta-data-option"> Aisle ', o_custkey, ' </div>',
        if(o_orderstatus = 'P', '', concat('<div class="main-description-body"><p>Sell ', o_orderpriority, '</p> <p>daily</p></div>')),
        '<a id="link-apply" href="/apply/', o_orderkey, '">Apply</a>')""",
    ),
}

RITEAID_LISTING = """concat('<div class="job-results-container"><search-job-cards><mat-accordion><mat-expansion-panel class="mat-expansion-panel m"><a href="/jobs/', o_orderkey,
    '" aria-label="', if(o_orderpriority = '5-LOW', 'Clerk', concat('Store Clerk ', o_orderkey)), '">x</a><span class="categories label-value"> ', o_orderstatus,
    ' <b>team</b></span></mat-expansion-panel></mat-accordion></search-job-cards></div>')"""


def detail_pages(spark, sf_dir: str, board: str) -> DataFrame:
    """Captured detail pages `(source, kind, page_no, url, html, captured_at)` of one board."""
    name, url, html = DETAIL_HTML[board]
    key = {"part": "p_partkey", "orders": "o_orderkey"}[name]
    return spread_table(spark, sf_dir, name, key).select(
        F.lit(board).alias("source"),
        F.lit("detail").alias("kind"),
        F.col(key).alias("page_no"),
        F.expr(url).alias("url"),
        F.expr(html).alias("html"),
        F.expr("timestamp '2021-12-31 10:20:30'").alias("captured_at"),
    )
