"""Small pages with labels: text blocks of elements with `data-main` belong to the article.

The decision tree is trained on the blocks of these pages.  They show articles with long and
short paragraphs, lists and links inside, and what stands around articles; some use elements
that say what they are, some only classes, some nothing but text.
"""

LONG = ("The river had risen for three days before anyone on the upper farms thought of moving "
        "the cattle, and by then the lower road was gone under a brown sheet of water. ")
MID = "Nobody in the village could remember a spring as wet as this one had been so far."

PAGES = [
    f"""<html><head><title>T</title></head><body><nav><ul><li><a href=a>Home</a><li><a href=b>News</a>
    <li><a href=c>Sport and leisure in the region</a></ul></nav><div class="ad">Buy new boots today, now at half
    the price in all of our shops.</div><article><h1 data-main>The river</h1><p data-main>{LONG * 2}</p>
    <p data-main>Rain.</p><p data-main>{MID}</p><p data-main>It fell.</p></article><footer>&copy; The paper. {MID}
    </footer></body></html>""",
    f"""<body><header><h2>The Daily Paper</h2><p>{MID}</p></header><main><h1 data-main>Wool prices</h1>
    <p data-main>{MID}</p><ul><li data-main>one</li><li data-main>two <a href=x>pages</a></li></ul>
    <p data-main>See <a href=y>the whole report</a></p><blockquote data-main>{LONG}</blockquote>
    <aside><p>Also read: {MID}</p></aside><p data-main>End.</p></main><form><p>Your name, please, and your
    address</p><label>Mail</label></form><section class="comments"><p>{LONG}</p><p>I agree.</p><p>{MID}</p>
    </section><footer><p>{LONG}</p></footer></body>""",
    f"""<body><div class="menu"><a href=1>Start</a> <a href=2>About us</a></div><div id="content"><h1 data-main>Bees</h1>
    <p data-main>{LONG}</p><p data-main>{MID}</p><p data-main>They swarm.</p><p data-main>{LONG * 3}</p></div>
    <div class="sidebar"><p>{MID}</p><p>{LONG}</p><ul><li><a href=1>Most read today</a></ul></div>
    <div id="cookie-notice"><p>We use cookies. {MID}</p></div><div class="footer">Imprint. {MID}</div></body>""",
    f"""<body><p><a href=1>Home</a> | <a href=2>Archive</a> | <a href=3>Contact</a></p><p data-main>{LONG}</p>
    <p data-main>{LONG * 2}</p><p data-main>So it was.</p><p data-main>{MID}</p><p><a href=4>Next page of this</a></p>
    <p><a href=5>Back to the list of all the reports</a></p></body>""",
    f"""<article><header><h1 data-main>Salt</h1><p data-main>By a guest</p></header><section><h2 data-main>One</h2>
    <p data-main>{LONG}</p><div class="advert">{LONG}</div><h2 data-main>Two</h2><p data-main>Short.</p>
    <p data-main>{MID}</p><table><tr><td data-main>salt</td><td data-main>4</td></tr></table>
    <p data-main><a href=z>A link that fills its paragraph</a></p></section><div class="share">Share this
    with your friends</div><section id="comments"><article><p>{MID}</p><p>No.</p></article></section></article>
    <aside class="related"><h3>More</h3><p><a href=q>{MID}</a></p></aside>""",
    f"""<body><nav>{MID} <a href=1>all of it</a></nav><aside>{LONG}</aside><article><p data-main>{LONG}</p>
    <p data-main>Yes.</p><form><p>{MID}</p></form><p data-main>{LONG}</p><nav><a href=1>2</a></nav></article>
    <footer><ul><li>Help<li>Terms of use and data protection</ul></footer></body>""",
    f"""<body><article><h1 data-main>One word</h1><p data-main>Gone.</p></article><footer>Gone.</footer></body>""",
    f"""<body><div class="banner">{LONG}</div><article><p data-main>Well.</p></article><div class="newsletter">
    <p>Subscribe.</p><p>{LONG}</p></div></body>""",
    f"""<body><header><a href=1>Logo</a></header><div class="ad">{MID}</div><article><h1 data-main>{MID}</h1>
    <p data-main>Hm.</p><p data-main>So.</p><p data-main>On.</p></article><footer>{MID}</footer></body>""",
    f"""<body><nav><p>{LONG * 3}</p><p>{LONG * 4}</p></nav><div class="ad">{LONG * 2}</div><div class="promo"><p>
    {LONG * 4}</p><p>{LONG * 3}</p></div><header><p>{LONG * 2}</p></header><div><h1 data-main>Long</h1><p data-main>
    {LONG * 3}</p><p data-main>Then.</p><p data-main>{LONG * 2}</p></div><aside><p>{LONG * 5}</p><p>{LONG * 2}</p></aside>
    <footer><p>{LONG * 3}</p><p>{LONG * 2}</p></footer><section id="comments"><p>{LONG * 3}</p><p>{LONG * 4}</p></section>
    <form><p>{LONG * 2}</p><p>{LONG * 3}</p></form></body>""",
    f"""<body><div class="cookie-bar"><p>{LONG * 2}</p></div><article><p data-main>{LONG * 4}</p><aside><p>{LONG * 4}</p>
    </aside><p data-main>{LONG * 2}</p><div class="related-posts"><p>{LONG * 2}</p></div><footer><p>{LONG * 3}</p></footer>
    </article><div class="notice">{LONG * 3}</div><footer>{LONG * 2}</footer></body>""",
    f"""<body><aside>{MID}</aside><p data-main>{LONG * 3}</p><p data-main>{MID}</p><aside>{LONG * 3}</aside>
    <div class="widget">{LONG * 3}</div><p data-main>{LONG * 4}</p><nav>{LONG * 2}</nav></body>""",
    # Pages that say nothing by their elements: only lengths, links and neighbours tell.
    f"""<body><div>Menu</div><div>News today</div><div>Sport</div><div data-main>{LONG}</div><div data-main>So.</div>
    <div data-main>{LONG * 2}</div><div data-main>{MID}</div><div data-main>{LONG}</div><div><a href=1>{LONG}</a></div>
    <div><a href=2>{MID}</a></div><div>Copyright of the paper</div></body>""",
    f"""<body><div>The Daily Paper</div><div><a href=1>Start</a></div><div><a href=2>All of our reports</a></div>
    <div data-main>{LONG * 3}</div><div data-main>It rained.</div><div data-main>{LONG}</div><div><a href=3>{LONG}</a></div>
    <div>Imprint</div></body>""",
    f"""<body><table><tr><td>Home</td><td>Shop</td><td>Help</td></tr></table><table><tr><td data-main>{LONG * 2}</td></tr>
    <tr><td data-main>Then it stopped.</td></tr><tr><td data-main>{LONG * 2}</td></tr></table><table><tr><td>Terms of use</td>
    </tr></table></body>""",
    # Articles with nothing around them.
    f"""<article><h1 data-main>Tin</h1><p data-main>{LONG}</p><p data-main>End.</p></article>""",
    f"""<body><article><p data-main>{MID}</p></article></body>""", "<main><p data-main>Gone.</p></main>",
    f"""<body><main><p data-main>A few words.</p><p data-main>{LONG * 2}</p><p data-main>{MID}</p></main></body>""",
    f"""<article><p data-main>One.</p><p data-main>Two of them.</p><p data-main><a href=1>All of it</a></p></article>""",
    f"""<nav><a href=1>Start</a></nav><article><h1 data-main>Lead</h1><p data-main>{LONG * 2}</p></article>""",
    # Names that mislead.
    f"""<body><div class="social-science"><h1 data-main>On towns</h1><p data-main>{LONG}</p><p data-main>Few.</p><p data-main>{MID}
    </p></div><div class="sidebar-left"><p>{LONG}</p></div></body>""",
    f"""<body><div class="content-with-sidebar"><p data-main>{LONG}</p><p data-main>{LONG}</p><h3>3 Responses</h3><div><p>{LONG}
    </p></div><div><p>No.</p></div></div></body>""",
]
