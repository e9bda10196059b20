"""The labelled table: blocks of a few pages, marked by hand. ``+`` is main text, ``-`` is not.

Each page is a list of (label, html); the html of a page is these pieces one after the other.
"""

PAGES: list[list[tuple[str, str]]] = [
    [
        ("-", "<html><body><nav><ul><li><a href='/'>Home</a></li>"),
        ("-", "<li><a href='/news'>News</a></li>"),
        ("-", "<li><a href='/about'>About us</a></li></ul></nav>"),
        ("-", "<div class='ad'>Buy two pairs of shoes and get the third one free this week only.</div>"),
        ("+", "<article><h1>The river is rising again</h1>"),
        ("+", "<p>After three days of rain the river has risen by almost two metres, and the lower streets of the town are closed.</p>"),
        ("+", "<p>Short.</p>"),
        ("+", "<p>Residents carried furniture upstairs, <a href='/x'>as they did in spring</a>, and waited for the boats to come.</p></article>"),
        ("-", "<footer>&copy; The Valley Paper &middot; All rights reserved. Printed on paper from the valley.</footer></body></html>"),
    ],
    [
        ("-", "<html><body><header><div>The Garden Letter</div>"),
        ("-", "<p>Everything about plants, soil, tools and weather, every week for the last twenty years.</p></header>"),
        ("-", "<aside><h3>Most read</h3>"),
        ("-", "<p>Ten plants that hardly ever need any water at all</p></aside>"),
        ("+", "<main><h1>Sowing beans</h1>"),
        ("+", "<p>Beans want warm soil. Wait until the nights stay mild, then press each seed two fingers deep.</p>"),
        ("+", "<ul><li>Soak the seeds</li>"),
        ("+", "<li>Loosen the soil</li></ul>"),
        ("+", "<blockquote>A bean sown in May overtakes a bean sown in April.</blockquote>"),
        ("-", "<div class='share'><a href='#'>Share</a> <a href='#'>Print</a></div></main>"),
        ("-", "<section id='comments'><h2>Comments</h2>"),
        ("-", "<p>I have tried this for years and it has never worked in my garden, but thank you for writing about it.</p>"),
        ("-", "<p>Lovely!</p></section>"),
        ("-", "<form><p>Your name</p>"),
        ("-", "<p>Write what you think of this article and press the button below</p></form></body></html>"),
    ],
    [
        ("-", "<html><body><div class='cookie-notice'>We use cookies to make this site work and to count its visitors.</div>"),
        ("-", "<div class='menu'><a href='a'>Start</a> <a href='b'>Products</a> <a href='c'>Contact</a></div>"),
        ("+", "<div><h2>How the bridge was built</h2>"),
        ("+", "<p>The first stone was laid in the winter of that year, when the water stood so low that carts could cross.</p>"),
        ("+", "<p>It took eleven years, four engineers and a change of government until the last arch was closed.</p>"),
        ("+", "<p>Today nine thousand people walk over it every day without thinking of any of them.</p></div>"),
        ("-", "<div class='sidebar'><p>Subscribe to our letter and never miss a story about bridges, tunnels and towers again.</p></div>"),
        ("-", "<div id='footer'><p>Imprint</p>"),
        ("-", "<p>Privacy, terms, cookies, press, jobs and everything else that nobody reads</p></div></body></html>"),
    ],
    [
        ("-", "<html><body><div><a href='1'>One</a> <a href='2'>Two</a> <a href='3'>Three</a> <a href='4'>Four</a></div>"),
        ("-", "<div><a href='5'>Five</a> <a href='6'>Six</a></div>"),
        ("+", "<div><p>The committee met on Tuesday and agreed on the plan for the new library after a long debate about its roof.</p>"),
        ("+", "<p>Building begins next year, said the chair, <a href='7'>if the money comes</a>, and ends two years later.</p></div>"),
        ("-", "<div><a href='8'>Older posts</a></div>"),
        ("-", "<div><a href='9'>Terms</a> <a href='10'>Help</a></div></body></html>"),
    ],
    [
        ("-", "<html><body><nav><p>A long line of words that stands in the navigation and links to nothing at all for once.</p></nav>"),
        ("+", "<article><header><h1>Title inside a header of the article</h1></header>"),
        ("+", "<p>One word</p>"),
        ("+", "<table><tr><td>Cell</td></tr>"),
        ("+", "<tr><td>Another cell with some more words in it than the first</td></tr></table>"),
        ("-", "<aside>Read also our other stories about this and that and everything in between</aside>"),
        ("+", "<pre>print('hello')</pre>"),
        ("+", "<p><a href='only'>A paragraph that is one single link inside the article</a></p></article>"),
        ("-", "<div class='banner'>Advertisement</div>"),
        ("-", "<div class='newsletter'><p>Sign up</p></div>"),
        ("-", "<footer><p>Written by the editors of this page in the spring of last year, and updated since.</p></footer></body></html>"),
    ],
    [
        ("-", "<html><body class='has-sidebar'><div id='page' class='no-sidebar header-fixed'><header><p>The Mountain Post</p></header>"),
        ("+", "<article class='post comments-open'><h1>Snow on the pass</h1>"),
        ("+", "<p>The pass was closed at noon, when the wind had laid a metre of snow over the road and the first cars stood still.</p>"),
        ("+", "<p>Nobody was hurt.</p>"),
        ("+", "<p>The ploughs will start at four in the morning, and the road is to be open again before the schools are.</p></article>"),
        ("-", "<div id='comments' class='comments-area'><article class='comment'><p>I was there in one of the cars, and I can tell you that it was colder than anyone says.</p></article></div>"),
        ("-", "<div class='widget'><p>Like us, follow us and tell your friends about us, wherever you are in the world today.</p></div></div></body></html>"),
    ],
    [
        ("-", "<html><body><div class='layout-header-sidebar'><div><a href='1'>Home</a> <a href='2'>Maps</a></div>"),
        ("+", "<article class='post'><h1>Bread without kneading</h1>"),
        ("+", "<p>Stir flour, water, salt and very little yeast in the evening, and leave the bowl alone until the next day.</p>"),
        ("+", "<p>Then fold it.</p>"),
        ("+", "<p>Bake it in a closed pot that has been in the oven for half an hour, and take the lid off for the last ten minutes.</p></article></div>"),
        ("-", "<div class='sidebar'><article><h3><a href='3'>Ten soups for cold days</a></h3>"),
        ("-", "<p><a href='4'>Read more</a></p></article>"),
        ("-", "<article><h3><a href='5'>What to do with old bread</a></h3>"),
        ("-", "<p><a href='6'>Read more</a></p></article></div></body></html>"),
    ],
    [
        ("-", "<html><body><form id='page-form'><div><a href='1'>Start</a> <a href='2'>Search</a></div>"),
        ("+", "<div class='with-sidebar'><main class='has-sidebar'><h1>The last tram</h1>"),
        ("+", "<p>On Saturday night the last tram of line nine left the depot with more people on board than in all of last year.</p>"),
        ("+", "<p>Some wept.</p>"),
        ("-", "<div class='sidebar'><p>More on trams, buses and trains in our large summer issue, out now at every station.</p></div>"),
        ("+", "<p>From Monday on there will be a bus, which takes the same way in a little more time.</p></main></div></form></body></html>"),
    ],
]
