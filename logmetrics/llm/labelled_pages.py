"""Labelled pages that the block classifier learns from.

Each page is a list of pieces ``(html, label)``: 1 main text, 0 around it, -1 markup
without text. Invented pages; a piece with text holds one block.
"""

P1 = "The harbour froze early that year, and the boats stayed in until the first week of April came round again."
P2 = "People who had lived there all their lives could not remember a winter like it, nor could their parents."
P3 = "Nobody spoke."
P4 = "When the ice broke, the council met in the old hall, counted what was left in the stores and wrote a plain report about the damage to the quays."

TOPICS = "boats nets quays cranes ice tides fish salt rope wind sails tar oars crews storms maps".split()
MENU = "<div>" + " ".join(f"<a href='/{k}'>All about {k}</a>" for k in TOPICS) + "</div>"
LONG_MENU = "<ul><li>" + " | ".join(f"<a href='/{k}/{n}'>{k} of the {n}</a>" for k in TOPICS[:8] for n in ("coast", "north")) + "</li></ul>"

PAGES = [
    [  # article with everything around it
        ("<head><title>Harbour</title></head><body><nav><ul><li><a href='/'>Home</a></li>", 0),
        ("<li><a href='/n'>News</a></li>", 0), ("<li><a href='/a'>About us</a></li></ul></nav>", 0),
        ("<div class='ad'>Buy two boats and get one free.</div>", 0),
        ("<article><h1>The long winter</h1>", 1), (f"<p>{P1}</p>", 1), (f"<p>{P2}</p>", 1), (f"<p>{P3}</p>", 1),
        ("<h2>After the ice</h2>", 1), (f"<p>{P4}</p>", 1), ("<ul><li>Two quays lost</li>", 1), ("<li>One crane bent</li></ul>", 1),
        ("<p>See <a href='/r'>the report</a>.</p>", 1), ("<p><a href='/more'>Read the whole report of the council here</a></p>", 1),
        ("<p>Yes.</p></article>", 1),
        ("<aside><h3>Also read</h3>", 0), (f"<p>{P2}</p></aside>", 0),
        ("<section class='comments'><h3>Comments</h3>", 0), (f"<p>Great story, thank you. {P1}</p>", 0), ("<p>Me too.</p></section>", 0),
        ("<form><label>Your name</label>", 0), ("<p>Your mail stays with us.</p>", 0), ("<button>Send</button></form>", 0),
        ("<footer><p>&copy; Harbour Post</p>", 0), ("<p>All rights reserved, and no part may be printed again without leave.</p></footer>", 0),
    ],
    [  # notices and adverts inside and around the article
        ("<div class='cookie-notice'><p>We use cookies to make this site work and to count visits. Please agree.</p></div>", 0),
        ("<header><h1>Harbour Post</h1>", 0), ("<p>The paper of the coast</p></header>", 0),
        ("<main><article><header><h1>Storm</h1>", 1), ("<p>By our writer at the coast</p></header>", 1), (f"<p>{P4}</p>", 1),
        ("<div class='advert'><p>Warm coats at half the price, today only, in all our shops.</p></div>", 0),
        (f"<p>{P1}</p>", 1), ("<blockquote>No one slept.</blockquote>", 1), ("<p>It passed.</p>", 1),
        ("<div class='share'><a href='#'>Share this</a></div>", 0),
        ("<div id='related'><p>More stories you may like from the coast and the hills</p></div>", 0),
        ("<div class='comment'><p>I was there and it was worse than that, believe me, far worse.</p></div></article></main>", 0),
        ("<div class='newsletter'><p>Get our letter every week.</p></div>", 0), ("<div class='footer'><p>Imprint</p></div>", 0),
    ],
    [  # no helpful names: words and links of the neighbours decide
        ("<div><a href='/'>Start</a> <a href='/b'>Boats</a> <a href='/c'>Coast</a></div>", 0),
        ("<div><a href='/l'>Log in</a></div>", 0),
        ("<h1>Ice on the river for the first time in years</h1>", 1), (f"<p>{P1} {P2}</p>", 1), (f"<p>{P4}</p>", 1), (f"<p>{P2} {P1}</p>", 1),
        ("<div><a href='/x'>Next page</a></div>", 0), ("<div><a href='/t'>Terms</a> <a href='/i'>Imprint</a></div>", 0),
    ],
    [
        ("<table><tr><td><a href='/1'>One</a></td>", 0), ("<td><a href='/2'>Two</a></td></tr></table>", 0),
        (f"<div>{P4} {P1}</div>", 1), (f"<div>{P2}</div>", 1), (f"<div>{P1}</div>", 1),
        ("<div><a href='/3'>Three</a></div>", 0), ("<div><a href='/4'>Back to the top of the page</a></div>", 0),
    ],
    [  # content named by class only
        ("<div class='menu'><p>Home</p>", 0), ("<p>Contact</p></div>", 0),
        ("<div class='post-content'><h2>Nets</h2>", 1), (f"<p>{P1}</p>", 1), ("<p>Done.</p>", 1), (f"<p>{P2} <a href='/z'>More</a></p></div>", 1),
        ("<div class='sidebar'><p>Weather: cold, with some snow in the evening and wind from the north.</p></div>", 0),
        ("<div role='contentinfo'><p>Made by hand in the north, since long before your time.</p></div>", 0),
    ],
    [  # short article
        ("<nav><a href='/'>Home</a></nav>", 0), ("<article><h1>Note</h1>", 1), ("<p>Short.</p>", 1), ("<p>Very short.</p></article>", 1),
        ("<footer>Imprint</footer>", 0),
    ],
    [
        ("<nav><a href='/'>Home</a></nav>", 0), ("<div class='ad'>Cheap nets for sale in the old market hall near the church.</div>", 0),
        ("<article><h1>Empty nets</h1>", 1), (f"<p>{P2}</p></article>", 1), ("<footer>Harbour Post &middot; printed on Mondays and Fridays.</footer>", 0),
    ],
    [  # plain words next to links only, and short paragraphs between long ones
        ("<div><a href='/'>Home</a></div>", 0), ("<div>The paper of the coast</div>", 0), ("<div><a href='/n'>News</a></div>", 0),
        (f"<p>{P4}</p>", 1), ("<p>Then it rained.</p>", 1), (f"<p>{P1}</p>", 1), (f"<p>{P2}</p>", 1), ("<p>That was all.</p>", 1), (f"<p>{P2}</p>", 1),
        ("<div><a href='/i'>Imprint</a></div>", 0), ("<div>Printed in the north</div>", 0), ("<div><a href='/t'>Terms</a></div>", 0),
        ("<div>Harbour Post, founded long ago</div>", 0),
    ],
    [
        ("<p><a href='/'>Front page</a></p>", 0), ("<p>You are here:</p>", 0), ("<p><a href='/n'>Coast</a></p>", 0),
        ("<h1>Ice again</h1>", 1), (f"<p>{P1}</p>", 1), (f"<p>{P2}</p>", 1), ("<p>Good night.</p>", 1), (f"<p>{P4}</p>", 1),
        ("<p><a href='/o'>Older</a></p>", 0), ("<p>Powered by paper</p>", 0), ("<p><a href='/r'>Feed</a></p>", 0),
    ],
    [  # in an article short and linked paragraphs stay, whatever stands next to them
        ("<nav><a href='/'>Home</a></nav>", 0), ("<article><h1>The boats came home late and empty</h1>", 1), ("<p>Empty.</p>", 1),
        ("<p><a href='/c'>Coast</a></p>", 1), ("<p>Then it rained.</p>", 1), ("<p>Again.</p>", 1),
        ("<p><a href='/p'>Pictures of the boats and the nets</a></p>", 1), (f"<p>{P1}</p>", 1), ("<p>Cold.</p>", 1),
        ("<p><a href='/w'>Weather</a></p>", 1), ("<p>Nobody was hurt in the storm.</p></article>", 1), ("<footer><a href='/i'>Imprint</a></footer>", 0),
    ],
    [
        ("<nav><a href='/'>Home</a></nav>", 0), ("<main><h1>Prices of fish this week</h1>", 1), ("<p>Up.</p>", 1), (f"<p>{P4}</p>", 1),
        ("<p><a href='/f'>All prices</a></p>", 1), ("<p>Prices are for one box.</p>", 1), ("<p>Ask.</p></main>", 1), ("<footer>Imprint</footer>", 0),
    ],
    [  # a reading list: nearly all links, all of it main text
        ("<nav><a href='/'>Home</a></nav>", 0), ("<article><h1>Books about ice</h1>", 1), ("<p>A list.</p>", 1),
        ("<p><a href='/1'>Ice</a></p>", 1), ("<p>New.</p>", 1), ("<p><a href='/2'>The northern sea in winter</a></p>", 1), ("<p>Out of print for years.</p>", 1),
        ("<p><a href='/3'>Snow</a></p>", 1), ("<p><a href='/4'>Boats and the men who built them by hand</a></p>", 1), ("<p>Old.</p>", 1),
        ("<p><a href='/5'>Frost</a></p>", 1), (f"<p>{P2}</p>", 1), ("<p><a href='/6'>Harbours</a></p>", 1), ("<p>Lent out at the moment.</p>", 1),
        ("<p><a href='/7'>Nets</a></p>", 1), ("<p><a href='/8'>Tides of the coast</a></p>", 1), ("<p>Ask at the desk.</p></article>", 1),
    ],
    [  # links right before and behind long texts, no names to help
        ("<div><a href='/'>Home</a> <a href='/n'>News</a></div>", 0), (f"<div>{P1}</div>", 1), (f"<div>{P2} {P4}</div>", 1),
        ("<div><a href='/o'>Older texts of ours</a></div>", 0), ("<div><a href='/i'>Imprint</a> <a href='/t'>Terms of use</a></div>", 0),
    ],
    [
        ("<table><tr><td><a href='/a'>Boats and nets</a></td></tr></table>", 0), (f"<div>{P4} {P2}</div>", 1), ("<div>It went on.</div>", 1), (f"<div>{P1}</div>", 1),
        ("<div><a href='/b'>What else we wrote about the coast and its harbours</a></div>", 0), (f"<div>{P2}</div>", 1),
        ("<div><a href='/c'>Sign in</a> or <a href='/d'>join us</a></div>", 0),
    ],
    [  # a page whose class names its topic: density outvotes it
        ("<div class='social privacy'><h1>How we share the quays with others</h1>", 1), (f"<p>{P1}</p>", 1), ("<p>Nobody was hurt.</p>", 1), (f"<p>{P4}</p>", 1),
        (f"<p>{P2} {P1}</p>", 1), ("<p><a href='/o'>Older</a></p>", 0), ("<p><a href='/i'>Imprint</a> <a href='/t'>Terms of use</a></p></div>", 0),
    ],
    [
        ("<div id='reviews'><p><a href='/'>Front page</a> <a href='/n'>News</a></p>", 0), (f"<p>{P4}</p>", 1), (f"<p>{P2}</p>", 1), ("<p>Then it rained.</p>", 1),
        (f"<p>{P1}</p></div>", 1), ("<div><a href='/l'>Log in</a></div>", 0), ("<div class='footer'>Imprint</div>", 0),
    ],
    [  # an article keeps all it holds, whatever its class says of its topic
        ("<nav><a href='/'>Home</a></nav>", 0), ("<article class='post hentry category-privacy tag-social'><h1>Ice</h1>", 1), ("<p>Short.</p>", 1), (f"<p>{P1}</p></article>", 1),
        ("<div class='comments'><p>I was there and it was worse than that, believe me, far worse.</p></div>", 0),
    ],
    [  # remarks below a text without names stay out, as most of the page is elsewhere
        ("<div><a href='/'>Home</a></div>", 0), (f"<div>{P4} {P1}</div>", 1), (f"<div>{P2}</div>", 1),
        (f"<div class='comments'><p>{P2}</p>", 0), (f"<p>{P1}</p></div>", 0), ("<div><a href='/i'>Imprint</a></div>", 0),
    ],
    [  # nothing but notices
        ("<div class='login'><p>Please sign in to go on.</p>", 0), ("<p>Your name</p>", 0), ("<p><a href='/f'>Forgot it?</a></p></div>", 0),
        ("<div class='cookie'><p>We use cookies.</p></div>", 0),
    ],
    [  # no names at all: a long menu, short headings, list items, two notices
        ("<div><a href='/'>Home</a> <a href='/n'>News</a></div>", 0),
        ("<div>" + " ".join(f"<a href='/{k}'>All about {k}</a>" for k in ("boats", "nets", "quays", "cranes", "ice", "tides", "fish", "salt", "rope")) + "</div>", 0),
        ("<h1>The ice of that year</h1>", 1), (f"<p>{P1}</p>", 1), ("<h2>Background</h2>", 1), (f"<p>{P2} {P4}</p>", 1), ("<p>Nobody spoke.</p>", 1),
        ("<ul><li>Two quays lost</li>", 1), ("<li>One crane bent</li>", 1), ("<li>No boats</li></ul>", 1), (f"<p>{P1}</p>", 1),
        ("<div><a href='/i'>Imprint</a> <a href='/t'>Terms</a></div>", 0),
        ("<div>&copy; Harbour Post. All rights reserved, and no part of it may be printed again anywhere without leave.</div>", 0),
        ("<div><p>This site sets cookies to count visits and to know you again. Who reads on agrees to that.</p></div>", 0),
    ],
    [  # a notice before the menu
        ("<div><p>This site keeps small files on your machine to work and to count visits. Please agree to go on.</p></div>", 0),
        ("<div><a href='/'>Home</a> <a href='/n'>News</a> <a href='/a'>About us</a></div>", 0),
        ("<h1>Storm</h1>", 1), (f"<p>{P4}</p>", 1), ("<p>By noon.</p>", 1), (f"<p>{P2}</p>", 1), (f"<p>{P1}</p>", 1),
        ("<div><a href='/i'>Imprint</a></div>", 0), ("<div>Printed on the coast.</div>", 0),
    ],
    [  # a poem
        ("<div><a href='/'>Home</a> <a href='/p'>Poems</a></div>", 0), ("<h1>Quay</h1>", 1), ("<p>The boats are in,</p>", 1), ("<p>the nets are dry,</p>", 1),
        ("<p>a gull walks by</p>", 1), ("<p>the harbour wall.</p>", 1), ("<p>It does not cry,</p>", 1), ("<p>it is not late,</p>", 1),
        ("<div><a href='/o'>Older</a> <a href='/i'>Imprint</a></div>", 0), ("<div>All rights reserved.</div>", 0),
    ],
    [  # one sentence
        ("<div><a href='/'>Home</a></div>", 0), (f"<p>{P1}</p>", 1), ("<div><a href='/i'>Imprint</a></div>", 0),
    ],
    [
        ("<div><a href='/'>Home</a> <a href='/n'>News</a></div>", 0), ("<p>The ferry is late today.</p>", 1), ("<div><a href='/i'>Imprint</a></div>", 0),
    ],
    [  # a long menu inside an article, without a name
        ("<nav><a href='/'>Home</a></nav>", 0), ("<article><h1>Salt</h1>", 1), (f"<p>{P4}</p>", 1),
        ("<div>" + " ".join(f"<a href='/{k}'>All about {k}</a>" for k in ("boats", "nets", "quays", "cranes", "ice", "tides", "fish", "salt", "rope", "wind")) + "</div>", 0),
        (f"<p>{P2}</p></article>", 1), ("<div>&copy; Harbour Post. All rights reserved, and no part of it may be printed again anywhere without leave.</div>", 0),
    ],
    [  # nothing but the text
        ("<h1>Nets</h1>", 1), (f"<p>{P1}</p>", 1), (f"<p>{P4} {P2}</p>", 1), ("<p>Done.</p>", 1),
    ],
    [("<p>The ferry is late today.</p>", 1)],
    [(f"<div>{P4} {P1}</div>", 1), (f"<div>{P2}</div>", 1)],
    [
        ("<div><a href='/'>Home</a> <a href='/n'>News</a></div>", 0), ("<h1>Rope</h1>", 1), (f"<p>{P2} {P4}</p>", 1), ("<p>That was all.</p>", 1),
    ],
    [("<article><h1>Ice</h1>", 1), (f"<p>{P2}</p>", 1), (f"<p>{P4} {P1} {P2}</p></article>", 1)],
    [  # long paragraphs between lines of links, in an article
        ("<nav><a href='/'>Home</a></nav>", 0), ("<article><h1>Three harbours</h1>", 1), (f"<p>{P1} {P4}</p>", 1), ("<p><a href='/1'>The first harbour</a></p>", 1),
        (f"<p>{P4} {P2}</p>", 1), ("<p><a href='/2'>The second harbour and its quays</a></p>", 1), (f"<p>{P2} {P1} {P4}</p>", 1), ("<p><a href='/3'>Third</a></p>", 1),
        (f"<p>{P4} {P1}</p>", 1), ("<p>Cold.</p></article>", 1), ("<footer>Imprint</footer>", 0),
    ],
    [  # the same without names
        ("<div><a href='/'>Home</a></div>", 0), ("<h1>Three harbours of the coast</h1>", 1), (f"<p>{P1} {P4}</p>", 1), ("<div><a href='/1'>More on it</a></div>", 0),
        (f"<p>{P4} {P2}</p>", 1), (f"<p>{P2} {P1}</p>", 1), ("<div><a href='/2'>More on the second harbour</a></div>", 0), (f"<p>{P2} {P1} {P4}</p>", 1), (f"<p>{P4} {P1}</p>", 1),
        ("<div><a href='/3'>All harbours</a></div>", 0), (f"<p>{P4} {P2} {P1}</p>", 1), ("<div><a href='/i'>Imprint</a> <a href='/t'>Terms</a></div>", 0),
    ],
    [  # remarks longer than the article
        ("<nav><a href='/'>Home</a></nav>", 0), ("<article><h1>Fish</h1>", 1), (f"<p>{P1}</p></article>", 1),
        (f"<div class='comments'><p>{P2} {P4}</p>", 0), ("<p>Me too.</p>", 0), (f"<p>{P4} {P1} {P2}</p>", 0), ("<p>So it was, and worse.</p></div>", 0), ("<footer>Imprint</footer>", 0),
    ],
    [
        ("<div class='banner'><p>Half the price, today only.</p>", 0), (f"<p>{P2} {P4}</p></div>", 0), ("<main><h1>Salt</h1>", 1), ("<p>It is dear.</p></main>", 1),
        (f"<aside><p>{P4}</p>", 0), (f"<p>{P1} {P2}</p></aside>", 0),
    ],
    [  # long menus between short and long texts, without names
        (MENU, 0), ("<h1>Tar and rope</h1>", 1), (f"<p>{P4} {P1}</p>", 1), ("<p>It dried.</p>", 1), (LONG_MENU, 0), (f"<p>{P2} {P4}</p>", 1), (f"<p>{P1} {P2}</p>", 1),
        ("<div><a href='/i'>Imprint</a></div>", 0), (LONG_MENU, 0), (MENU, 0), ("<div>Harbour Post, printed on the coast since long before your time, by hand.</div>", 0),
    ],
    [
        (LONG_MENU, 0), (MENU, 0), (f"<div>{P2} {P1}</div>", 1), (MENU, 0),
    ],
    [  # a short article at the end, after something named around it
        ("<div class='promo'><p>Warm coats at half the price, today only, in all our shops.</p></div>", 0), ("<article><h1>Late boats</h1>", 1),
        ("<p>They came at noon.</p>", 1), ("<p>All of them, with full nets and cold hands.</p>", 1), ("<p>Good.</p></article>", 1),
    ],
    [
        ("<footer><p>Printed by us.</p></footer>", 0), ("<article><h1>Tar</h1>", 1), ("<p>It is black.</p>", 1), ("<p>Smell it.</p></article>", 1),
    ],
    [
        ("<aside><p>More on tar, on rope and on all that is sold on the quay.</p></aside>", 0), ("<main><p>It is sold out, and nobody knows when more will come.</p>", 1), ("<p>Wait.</p></main>", 1),
    ],
    [  # the same the other way round
        ("<article><h1>Low tide</h1>", 1), ("<p>Walk with care.</p>", 1), ("<p>Stay near the wall until noon.</p>", 1), ("<p>Go.</p></article>", 1),
        ("<div class='ad'>Boots, dry and warm, at the market this week only.</div>", 0),
    ],
    [
        ("<article><h1>High tide</h1>", 1), ("<p>Wait.</p></article>", 1), ("<form><label>Your name</label>", 0), ("<button>Send it</button></form>", 0),
    ],
    [  # named by its topic, with a footer right behind
        ("<div class='popular'><p><a href='/'>Start</a> <a href='/n'>Coast</a></p>", 0), (f"<p>{P2}</p>", 1), (f"<p>{P1} {P4}</p></div>", 1), ("<div class='footer'>Contact</div>", 0),
    ],
    [
        ("<div class='sharing'><p><a href='/'>Start</a></p>", 0), (f"<p>{P4}</p>", 1), (f"<p>{P2} {P1}</p></div>", 1), ("<div class='foot'>All rights reserved</div>", 0),
    ],
]
