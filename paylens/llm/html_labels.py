"""The labelled table of the block classifier: pages whose main blocks carry ``data-main``."""

_LONG = ("The council met on Monday to talk about the bridge, and after two hours of argument it agreed to ask for "
         "three new offers before the summer. Nobody expects the work to begin this year.")
_MIDDLE = "She said the river had been rising for days, and that most people had already left."
_SHORT = "Nobody was hurt."

# Invented pages in the layouts that sites use, marked by hand.
PAGES = [
    f"""<body><nav><ul><li><a href=1>Home</a></li><li><a href=2>News</a></li><li><a href=3>Sport</a></li></ul></nav>
    <div class="ad">Buy two pairs of shoes and get the third one for free, only this week.</div>
    <article><h1 data-main>Bridge talks go on</h1><p data-main><b>{_LONG}<br data-main>And more.<p data-main>{_SHORT}</p><p data-main>{_MIDDLE}</p>
    <p data-main>{_LONG}</p></article><footer>&copy; The Paper. {_MIDDLE}</footer></body>""",
    f"""<body><header><a href=1>The Paper</a> {_MIDDLE}</header><main><h1 data-main>River keeps rising</h1><p data-main>{_MIDDLE}</p>
    <p data-main>{_SHORT}</p><aside><h3>Read next</h3><p>{_MIDDLE}</p></aside><p data-main>{_LONG} <a href=5>More here</a>.</p>
    <ul><li data-main>Bring warm clothes and some water.</li><li data-main>Do not use the old road.</li></ul></main>
    <footer><p>{_LONG}</p><p><a href=1>Imprint</a> <a href=2>Privacy</a></p></footer></body>""",
    f"""<body><div id="top-menu"><a href=1>Start</a> <a href=2>About</a> <a href=3>Shop</a></div><div class="cookie-notice"><p>{_MIDDLE}</p>
    <button>Agree</button></div><div class="content"><h1 data-main>A quiet week</h1><p data-main>{_LONG}</p><p data-main>{_MIDDLE}</p>
    <blockquote data-main>{_LONG}</blockquote><p data-main>{_LONG}</p></div><div class="comments"><h2>Comments</h2><p>{_SHORT}</p><p>{_LONG}</p></div>
    <div class="sidebar"><p>{_LONG}</p><ul><li><a href=4>Ten best cakes</a></li></ul></div></body>""",
    f"""<body><div class="masthead">The Daily Post {_MIDDLE}</div><article><h1 data-main>New trees for the square</h1>
    <div class="share"><a href=1>Mail</a> <a href=2>Print</a></div><p data-main>{_SHORT}</p><h2 data-main>What it costs</h2><p data-main>{_LONG}</p>
    <div class="advert"><p>{_LONG}</p></div><p data-main>{_MIDDLE}</p><table><tr><td data-main>Oak</td><td data-main>forty</td></tr></table>
    <form><p>{_MIDDLE}</p><label>Your mail</label></form><p data-main>{_SHORT}</p></article>
    <section class="comments"><p>{_MIDDLE}</p><p>{_LONG}</p></section></body>""",
    f"""<body><header><h1>The Evening Star</h1><p>{_SHORT}</p></header><nav><p>{_MIDDLE}</p><a href=1>All topics</a></nav>
    <article><h1 data-main>Old mill sold</h1><p data-main>{_LONG}</p><p data-main>{_SHORT}</p><footer>{_LONG}</footer></article>
    <aside class="related"><p>{_LONG}</p><p>{_SHORT}</p></aside><div class="newsletter"><p>{_LONG}</p></div></body>""",
    f"""<body><p><a href=1>Home</a> <a href=2>Archive</a> <a href=3>Contact</a></p><div><h2 data-main>How we built it</h2>
    <p data-main>{_LONG}</p><p data-main>{_LONG}</p><p data-main>{_MIDDLE}</p><p data-main>{_LONG}</p></div>
    <p><a href=4>Older</a> <a href=5>Newer</a></p><div id="footer"><p>{_MIDDLE}</p></div></body>""",
    f"""<body><div><ul><li><a href=1>One</a></li><li><a href=2>Two words</a></li><li><a href=3>Three</a></li></ul></div>
    <div class="notice">{_LONG}</div><main><article><p data-main>{_SHORT}</p><p data-main>{_MIDDLE}</p><ul><li data-main>{_SHORT}</li>
    <li data-main><a href=4>A linked source</a></li></ul><div class="comment-list"><p>{_SHORT}</p></div></article></main>
    <div class="promo"><p>{_SHORT}</p></div><footer>Imprint</footer></body>""",
    f"""<body><article><h1 data-main>Short</h1><p data-main>{_SHORT}</p></article><div class="comments"><article><p>{_MIDDLE}</p></article>
    <article><p>{_SHORT}</p></article></div><aside><p>{_SHORT}</p></aside></body>""",
    # No class and no element tells here: only the words and links of a block and of those around it.
    f"""<body><div><a href=1>Home</a></div><div><a href=2>News</a></div><div>Topics</div><div><a href=3>Sport</a></div><div><a href=4>Weather</a></div>
    <div data-main>A bridge for two towns</div><div data-main>{_LONG}</div><div data-main>{_SHORT}</div><div data-main>{_MIDDLE}</div><div data-main>{_LONG}</div>
    <div><a href=5>Next story</a></div><div>More from us</div><div><a href=6>Ten best cakes</a></div><div><a href=7>Imprint</a></div></body>""",
    f"""<body><table><tr><td><a href=1>Start</a></td><td><a href=2>Archive</a></td><td>Menu</td><td><a href=3>Shop</a></td></tr></table>
    <div data-main>Snow in April</div><div data-main>{_MIDDLE}</div><div data-main>{_LONG}</div><div data-main>{_SHORT}</div><div data-main>{_LONG}</div>
    <div data-main>{_MIDDLE}</div><div><a href=4>Older</a></div><div>Page two</div><div><a href=5>Newer</a></div><div>All prices in euros</div><div><a href=6>Contact</a></div></body>""",
    f"""<body><div><a href=1>One</a></div><div>Today</div><div><a href=2>Two words</a></div><div>Also read</div><div><a href=3>Three</a></div>
    <div data-main>The last ferry</div><div data-main>{_LONG}</div><div data-main>What it cost</div><div data-main>{_LONG}</div><div data-main>{_SHORT}</div>
    <div data-main>{_LONG}</div><div><a href=8>Send this to a friend</a></div><div>Follow us</div><div><a href=9>Mail</a></div></body>""",
    f"""<body><article><h1 data-main>A short note</h1><p data-main><a href=1>A linked source</a></p><p data-main>Why it matters</p><p data-main><a href=2>The full report</a></p>
    <p data-main>{_SHORT}</p></article><p><a href=3>Home</a></p><p>Our other pages</p><p><a href=4>Archive</a></p></body>""",
    f"""<body><nav><a href=1>Home</a><p>All topics</p><p>Today</p></nav><article><h1 data-main>Prices</h1><div class="ad">Buy now</div><h2 data-main>Fruit</h2>
    <p data-main>Apples</p><p data-main>Two euros</p><p data-main>Pears</p><p data-main>Four euros</p><h2 data-main>From us</h2><p data-main>Honey</p><p data-main>Nine euros</p>
    <div class="promo"><p>Only today</p><p>Sale</p><p>{_MIDDLE}</p></div><p data-main>{_LONG}</p><p data-main>The end</p><p data-main><a href=2>Full list</a></p>
    <div class="share">Tell others</div></article><aside><p>Read next</p><p>Cakes</p></aside><footer><p>Imprint</p><p>The Paper</p></footer></body>""",
    f"""<body><header><p>The Star</p><p>Since 1950</p></header><main><h1 data-main>Results</h1><ul><li data-main>North</li><li data-main>Three two</li><li data-main>South</li>
    <li data-main>One nil</li></ul><div class="comments"><p>Well played</p><p>Lovely</p><p>{_SHORT}</p><p>{_MIDDLE}</p></div><p data-main>Next week</p><p data-main>{_SHORT}</p>
    <div class="newsletter"><p>Sign up</p><p>Free</p></div></main><div class="footer"><p>About us</p><p>Jobs</p></div></body>""",
    f"""<body><div><a href=1>Home</a></div><div>Our other pages</div><div><a href=2>News</a></div><div>All topics of today</div><div><a href=3>Sport</a></div>
    <div data-main>Prices</div><div data-main>{_LONG}</div><div data-main>Apples</div><div data-main>{_MIDDLE}</div><div data-main>Two euros</div><div data-main>{_LONG}</div>
    <div data-main>Pears</div><div data-main>{_MIDDLE}</div><div><a href=4>Older</a></div><div>Read what others say</div><div><a href=5>Newer</a></div><div>Write to us here</div><div><a href=6>Mail</a></div></body>""",
    f"""<body><div><a href=1>One</a></div><div>Open every day</div><div><a href=2>Two words</a></div><div>Four more stories</div><div><a href=3>Three</a></div>
    <div data-main>Snow</div><div data-main>{_MIDDLE}</div><div data-main>It melted</div><div data-main>{_LONG}</div><div data-main>Rain</div><div data-main>{_MIDDLE}</div>
    <div data-main>Sun again</div><div data-main>{_LONG}</div><div><a href=4>Older</a></div><div>You are on page two</div><div><a href=5>Newer</a></div></body>""",
    f"""<body><article><nav><p><a href=1>Part one</a></p><p><a href=2>Part two</a></p><p><a href=3>All parts</a></p></nav><h1 data-main>The harbour</h1><p data-main>{_LONG}</p>
    <div class="share"><p><a href=4>Mail</a></p><p><a href=5>Print</a></p></div><p data-main>{_MIDDLE} <a href=6>She wrote about it last year too</a>.</p>
    <div class="related"><p><a href=7>Ten best cakes</a></p><p>See also <a href=8>the old mill</a></p><p><a href=9>River keeps rising</a></p></div>
    <p data-main>{_SHORT} <a href=10>See the report</a>.</p><p data-main><a href=11>The offers in full</a></p><footer><p><a href=12>Print</a></p><p><a href=13>Next part</a></p></footer>
    <div class="comments"><p>{_SHORT} <a href=14>Reply</a></p><p><a href=15>Report</a></p><p>{_MIDDLE} <a href=16>Reply</a></p></div></article></body>""",
    f"""<body><div><a href=1>Home</a></div><div><a href=2>News</a></div><div data-main>What we know</div><div data-main>{_LONG} <a href=3>A map of the river and of the roads</a>.</div>
    <div data-main>{_MIDDLE} <a href=4>Read her letter here</a>.</div><div data-main>{_SHORT} <a href=5>See why</a>.</div><div data-main>{_MIDDLE} <a href=6>The old road is closed</a>.</div>
    <div data-main>{_LONG}</div><div><a href=7>Older</a></div><div><a href=8>Newer</a></div></body>""",
    f"""<body><main><h1 data-main>Ferry sold</h1><p data-main>{_MIDDLE} <a href=1>More on this</a>.</p><aside><p><a href=2>Best ferries</a></p><p><a href=3>All ships of the town</a></p>
    <p>Most read: <a href=4>Snow</a></p></aside><ul><li data-main><a href=5>The contract</a></li><li data-main><a href=6>The letter</a></li></ul><div class="pager"><p><a href=7>Older</a></p>
    <p><a href=8>Newer</a></p></div><div class="promo"><p>Buy <a href=9>shoes</a></p><p><a href=10>Buy hats and coats</a></p></div></main><div><a href=11>Contact</a></div></body>""",
    f"""<body><div><a href=1>Home</a></div><article><h1 data-main>A list of sources</h1><p data-main>Apples</p><p data-main><a href=2>The market</a></p><p data-main>{_MIDDLE}</p>
    <p data-main>Pears</p><p data-main><a href=3>The farm</a></p><p data-main>{_LONG}</p><p data-main>The end</p><p data-main><a href=4>The shop</a></p><p data-main>And so it was</p>
    <p data-main>Honey</p><p data-main><a href=5>The bees</a></p><p data-main>{_SHORT}</p><p data-main>Nuts</p><p data-main><a href=6>The wood</a></p><p data-main>Snow came early</p><p data-main>Rain</p></article>
    <div><a href=7>Older</a></div><main><h1 data-main>It snowed in the north</h1><p data-main>Again</p><ul><li data-main><a href=8>A map</a></li><li data-main>{_SHORT}</li><li data-main>Ice</li></ul></main></body>""",
]
