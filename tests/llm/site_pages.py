"""Pages written by hand after layouts that are common on the web, with the blocks of their main text.

None of them was used for training, and their words, names and structure come from no generator.
"""

PAGES = {}


def page(name, html, *blocks):
    PAGES[name] = (html, list(blocks))


page(
    "plain page",
    "<body><p>One paragraph of a plain page about nothing in particular.</p><p>Another one, which is a little longer than the first.</p><hr><a href=/>Back</a>",
    "One paragraph of a plain page about nothing in particular.",
    "Another one, which is a little longer than the first.",
)
page(
    "no tags",
    "Just some text that somebody saved as a page. It has no tags at all &amp; yet it is the whole content of the file.",
    "Just some text that somebody saved as a page. It has no tags at all & yet it is the whole content of the file.",
)
page("one bold line", "<html><body><b>The server moves to a new address on Monday morning.</b></body></html>", "The server moves to a new address on Monday morning.")
page(
    "post in main-col",
    """<html><head><title>Post</title></head><body><div class="top-bar"><a href="/">Home</a> <a href="/blog">Blog</a></div>
<div class="main-col"><h1>Finding things again</h1>
<p>When I search for an old letter I first look through the menu of the archive, then share what I find with my sister.</p>
<p>Privacy is no concern of ours, and her comments on each letter are often better than the letters.</p>
<p>We reply to one another by post.</p></div>
<div class="right-col"><h3>Archive</h3><ul><li><a href="/1">May</a></li><li><a href="/2">June</a></li></ul></div>
<div class="bottom">Copyright 2019 A. Writer</div></body></html>""",
    "Finding things again",
    "When I search for an old letter I first look through the menu of the archive, then share what I find with my sister.",
    "Privacy is no concern of ours, and her comments on each letter are often better than the letters.",
    "We reply to one another by post.",
)
page(
    "encyclopedia",
    """<!DOCTYPE html><html><head><title>Heron - Encyclopedia</title></head><body class="skin">
<div id="content" class="mw-body"><h1 id="firstHeading">Heron</h1><div id="siteSub" class="noprint">From the open encyclopedia</div>
<div id="bodyContent"><p>Herons are long-legged, long-necked birds of fresh water and coasts.</p>
<div id="toc" class="toc"><h2>Contents</h2><ul><li><a href="#a">1 Description</a></li><li><a href="#b">2 Diet</a></li><li><a href="#c">3 Notes</a></li></ul></div>
<h2>Description</h2><p>They are medium-sized to large birds with long legs and necks, and fly with the neck drawn in.</p>
<p>Sexes look alike in most species.</p>
<h2>Diet</h2><p>Most of them eat fish, frogs and insects, which they hunt by standing still in shallow water.</p></div>
<div class="catlinks">Categories: <a href="/c1">Birds</a> | <a href="/c2">Wading birds</a></div></div>
<div id="mw-navigation"><h2>Navigation menu</h2><ul><li><a href="/login">Log in</a></li><li><a href="/talk">Talk</a></li></ul></div>
<div id="footer"><ul><li>This page was last edited on 3 May.</li><li><a href="/privacy">Privacy policy</a></li></ul></div></body></html>""",
    "Heron",
    "Herons are long-legged, long-necked birds of fresh water and coasts.",
    "Description",
    "They are medium-sized to large birds with long legs and necks, and fly with the neck drawn in.",
    "Sexes look alike in most species.",
    "Diet",
    "Most of them eat fish, frogs and insects, which they hunt by standing still in shallow water.",
)
page(
    "news with article",
    """<!doctype html><html lang=en><head><meta charset=utf-8><title>Bridge closed</title><script>track()</script></head><body>
<header class="masthead"><div class="logo"><a href="/">The Daily Page</a></div><nav><ul><li><a href="/w">World</a></li><li><a href="/s">Sport</a></li></ul></nav></header>
<main><article><h1>Old bridge closed for repairs</h1><p>The bridge over the mill stream will be closed from Monday, the council said.</p>
<div class="ad-slot"><span>Advertisement</span></div>
<p>Drivers are asked to use the road through the village until the work is done.</p>
<aside class="related"><h4>Related</h4><a href="/x">Mill sold to local family</a></aside>
<p>The repairs are expected to take six weeks.</p></article></main>
<section class="comments"><h3>2 Comments</h3><div class="comment"><p>About time too, that bridge has been shaking for years.</p></div></section>
<footer><p>&copy; The Daily Page. All rights reserved.</p></footer></body></html>""",
    "Old bridge closed for repairs",
    "The bridge over the mill stream will be closed from Monday, the council said.",
    "Drivers are asked to use the road through the village until the work is done.",
    "The repairs are expected to take six weeks.",
)
page(
    "weblog theme",
    """<html><body class="home single-post"><div id="page" class="hfeed site"><header id="masthead"><p class="site-title"><a href="/">Garden Notes</a></p>
<div id="site-navigation" class="main-navigation"><ul class="nav-menu"><li class="menu-item"><a href="/about">About</a></li><li class="menu-item"><a href="/c">Contact</a></li></ul></div></header>
<div id="primary" class="content-area"><div id="content" class="site-content"><div class="post type-post hentry"><h1 class="entry-title">Planting garlic</h1>
<div class="entry-content"><p>Garlic goes into the ground in October here, a hand apart and two fingers deep.</p>
<ul><li>Break the bulbs into cloves.</li><li>Keep the skins on.</li></ul><blockquote><p>Plant on the shortest day, lift on the longest.</p></blockquote>
<p>By June the leaves turn yellow, and then it is time.</p></div></div>
<div id="comments" class="comments-area"><h2 class="comments-title">One thought on garlic</h2><ol class="comment-list"><li class="comment"><div class="comment-content"><p>Mine never grows that large, whatever I do.</p></div></li></ol></div></div></div>
<div id="secondary" class="widget-area"><aside class="widget widget_recent"><h3 class="widget-title">Recent Posts</h3><ul><li><a href="/1">Pruning</a></li><li><a href="/2">Frost</a></li></ul></aside></div>
<footer id="colophon" class="site-footer"><div class="site-info"><a href="#">Proudly powered by software</a></div></footer></div></body></html>""",
    "Planting garlic",
    "Garlic goes into the ground in October here, a hand apart and two fingers deep.",
    "Break the bulbs into cloves.",
    "Keep the skins on.",
    "Plant on the shortest day, lift on the longest.",
    "By June the leaves turn yellow, and then it is time.",
)
page(
    "manual",
    """<html><head><title>Install</title></head><body><div class="related" role="navigation"><h3>Navigation</h3><ul><li class="right"><a href="genindex">index</a></li><li><a href="next">next</a></li></ul></div>
<div class="document"><div class="documentwrapper"><div class="bodywrapper"><div class="body" role="main"><section id="install"><h1>Installation</h1>
<p>Unpack the archive and change into its folder before you run any of the commands below.</p><pre>make
make install</pre><p>You need a compiler for this step.</p></section></div></div></div>
<div class="sphinxsidebar" role="navigation"><h3>Table of Contents</h3><ul><li><a href="#">Installation</a></li></ul><div class="searchbox"><form action="/s"><input name="q"><input type="submit" value="Go"></form></div></div></div>
<div class="footer" role="contentinfo">&#169; Copyright 2020, the authors. Created using a tool.</div></body></html>""",
    "Installation",
    "Unpack the archive and change into its folder before you run any of the commands below.",
    "make make install",
    "You need a compiler for this step.",
)
page(
    "old home page",
    """<HTML><HEAD><TITLE>My page</TITLE></HEAD><BODY BGCOLOR=white><CENTER><H1>Welcome to my trains</H1></CENTER>
<P>I have built model trains since I was nine years old, and this page shows some of them.
<P>The first one is a steam engine made of tin, which my uncle gave me.
<HR><A HREF="index.html">Home</A> | <A HREF="guest.html">Guestbook</A></BODY></HTML>""",
    "Welcome to my trains",
    "I have built model trains since I was nine years old, and this page shows some of them.",
    "The first one is a steam engine made of tin, which my uncle gave me.",
)
page(
    "table layout",
    """<html><body><table width=100%><tr><td colspan=2><font size=5>Village choir</font></td></tr><tr><td width=150><p><a href=a>Home</a></p><p><a href=b>Concerts</a></p><p><a href=c>Members</a></p></td>
<td><h2>Spring concert</h2><p>Our spring concert takes place in the old church on the last Sunday of April.</p><p>Admission is free, but we are glad about every gift for the organ.</p></td></tr>
<tr><td colspan=2><small>&copy; Village choir 2004</small></td></tr></table></body></html>""",
    "Spring concert",
    "Our spring concert takes place in the old church on the last Sunday of April.",
    "Admission is free, but we are glad about every gift for the organ.",
)
page(
    "hashed class names",
    """<!DOCTYPE html><html><head><title>x</title></head><body><div id="root"><div class="css-1kq9z"><div class="css-99a"><a href="/">Feed</a></div><div class="css-99a"><a href="/m">Messages</a></div><div class="css-99a"><a href="/p">Profile</a></div></div>
<div class="css-7pd0x"><div class="css-2bb"><h1 class="css-t1">How we moved the database</h1><p class="css-p">Last year our database had grown so large that no single machine could hold it any more.</p>
<p class="css-p">So we split it by customer, which took three months and two attempts.</p><h2 class="css-t2">What went wrong</h2><p class="css-p">The first attempt failed because nobody had thought of the backups.</p></div></div>
<div class="css-f00"><div><a href="/t">Terms</a></div><div><a href="/h">Help</a></div></div></div></body></html>""",
    "How we moved the database",
    "Last year our database had grown so large that no single machine could hold it any more.",
    "So we split it by customer, which took three months and two attempts.",
    "What went wrong",
    "The first attempt failed because nobody had thought of the backups.",
)
page(
    "cookie banner",
    """<html><body><div class="cookie-consent" id="gdpr"><p>We use cookies to make this site work for you. By going on you accept our cookies.</p><button>Accept</button></div>
<div class="wrapper"><div class="story"><h1>The lighthouse keeper</h1><p>For thirty years Anna Holm lit the lamp each evening and put it out each morning.</p><p>Now the light is automatic, but she still lives in the house below it.</p></div></div>
<div class="newsletter-signup"><p>Subscribe to our newsletter</p><form><label>Email</label><button>Subscribe</button></form></div></body></html>""",
    "The lighthouse keeper",
    "For thirty years Anna Holm lit the lamp each evening and put it out each morning.",
    "Now the light is automatic, but she still lives in the house below it.",
)
page(
    "recipe",
    """<html><body><nav class="breadcrumb"><a href="/">Home</a> &gt; <a href="/soups">Soups</a></nav><main class="recipe"><h1>Leek soup</h1><p>A plain soup for cold days that needs half an hour and no skill.</p>
<h2>Ingredients</h2><ul><li>3 leeks</li><li>2 potatoes</li><li>1 litre of stock</li></ul><h2>Method</h2><ol><li>Wash and slice the leeks.</li><li>Cook them slowly in butter, add the rest and simmer for twenty minutes.</li></ol></main>
<div class="share-buttons"><a href="#">Tweet</a> <a href="#">Pin it</a></div><div class="related-posts"><h3>You may also like</h3><ul><li><a href="/a">Bean stew</a></li><li><a href="/b">Onion tart</a></li></ul></div></body></html>""",
    "Leek soup",
    "A plain soup for cold days that needs half an hour and no skill.",
    "Ingredients",
    "3 leeks",
    "2 potatoes",
    "1 litre of stock",
    "Method",
    "Wash and slice the leeks.",
    "Cook them slowly in butter, add the rest and simmer for twenty minutes.",
)
page(
    "mail archive",
    """<html><body><pre>From: Jan
Subject: build

The build has been broken since Tuesday because of a missing header file.
I will mend it tonight unless somebody else is faster.</pre></body></html>""",
    "From: Jan Subject: build The build has been broken since Tuesday because of a missing header file. I will mend it tonight unless somebody else is faster.",
)
page(
    "French newspaper",
    """<!DOCTYPE html><html lang="fr"><body><header id="entete"><a href="/">Le Journal</a><nav><ul><li><a href="/p">Politique</a></li><li><a href="/c">Culture</a></li></ul></nav></header>
<div class="article__content"><h1>Le marché rouvre ses portes</h1><p>Après deux ans de travaux, le marché couvert accueille de nouveau ses clients.</p><p>Les commerçants, eux, attendaient ce jour avec impatience.</p></div>
<aside class="article__aside"><h2>Les plus lus</h2><ul><li><a href="/1">La gare fermée</a></li><li><a href="/2">Un nouveau parc</a></li></ul></aside><footer class="pied"><p>Mentions légales</p></footer></body></html>""",
    "Le marché rouvre ses portes",
    "Après deux ans de travaux, le marché couvert accueille de nouveau ses clients.",
    "Les commerçants, eux, attendaient ce jour avec impatience.",
)
page(
    "office notice",
    """<html><body><div id="header"><h2>Town of Example</h2></div><div id="nav"><ul><li><a href="/">Start</a></li><li><a href="/f">Forms</a></li><li><a href="/o">Offices</a></li></ul></div>
<div id="main"><h1>Waste collection</h1><p>Bins are emptied every second Wednesday. Please put them out before six o'clock in the morning.</p>
<table><tr><th>Street</th><th>Day</th></tr><tr><td>Mill Lane</td><td>Wednesday</td></tr></table><p>Glass is collected on Fridays.</p></div>
<div id="footer">Town of Example, 1 Main Street</div></body></html>""",
    "Waste collection",
    "Bins are emptied every second Wednesday. Please put them out before six o'clock in the morning.",
    "Street",
    "Day",
    "Mill Lane",
    "Wednesday",
    "Glass is collected on Fridays.",
)
page(
    "story in sections",
    """<html><body><div class="site-header"><a class="brand" href="/">Reader</a></div><section class="chapter"><h1>Chapter One</h1><p>It rained on the day they came to the valley, and it rained on every day after.</p><p>"We should have stayed," said Tom.</p><p>Nobody answered.</p></section>
<section class="chapter"><h2>Chapter Two</h2><p>On the ninth day the sun came out, and with it the neighbours.</p></section><div class="pager"><a href="/prev">Previous</a> <a href="/next">Next</a></div></body></html>""",
    "Chapter One",
    "It rained on the day they came to the valley, and it rained on every day after.",
    '"We should have stayed," said Tom.',
    "Nobody answered.",
    "Chapter Two",
    "On the ninth day the sun came out, and with it the neighbours.",
)
page(
    "paragraphs in divs",
    """<html><body><div class="nav-wrap"><a href="/">Start</a><a href="/faq">FAQ</a></div><div class="textBlock"><div>The first snow fell in the night, and in the morning the whole street was quiet.</div><div>Children were the first to go out.</div><div>By noon there were nine snowmen and no snow left on the lawns.</div></div><div class="fineprint">All rights reserved. Terms and privacy.</div></body></html>""",
    "The first snow fell in the night, and in the morning the whole street was quiet.",
    "Children were the first to go out.",
    "By noon there were nine snowmen and no snow left on the lawns.",
)
page(
    "letter without paragraphs",
    """<html><head><title>Letter</title></head><body>Dear all,<br><br>the meeting of next week has to be moved to Thursday, as the hall is being painted.<br><br>Yours, the secretary</body></html>""",
    "Dear all, the meeting of next week has to be moved to Thursday, as the hall is being painted. Yours, the secretary",
)
page(
    "product with reviews",
    """<html><body><div class="navbar"><ul><li><a href="/">Shop</a></li><li><a href="/cart">Cart</a></li></ul></div><div class="product-page"><h1>Oak chair</h1><div class="description"><p>A chair of solid oak, made by hand in our own workshop and oiled three times.</p><p>It carries up to a hundred and fifty kilos.</p></div></div>
<div class="reviews comments"><h3>Reader comments</h3><div class="comment"><p>Arrived quickly and looks lovely in our kitchen.</p></div></div><div class="footer-links"><ul><li><a href="/r">Returns</a></li><li><a href="/i">Imprint</a></li></ul></div></body></html>""",
    "Oak chair",
    "A chair of solid oak, made by hand in our own workshop and oiled three times.",
    "It carries up to a hundred and fifty kilos.",
)
page(
    "text with many links",
    """<html><body><div class="page-header"><a href="/">Field guide</a></div><article class="entry"><h1>Oak</h1><p>The <a href="/o">oak</a> is a <a href="/t">tree</a> of the <a href="/b">beech family</a> that can grow very old and feeds <a href="/j">jays</a>, <a href="/s">squirrels</a> and many others.</p><p>Its wood is hard and was used for <a href="/sh">ships</a>.</p></article><div class="tags">Tags: <a href="/tt">trees</a>, <a href="/ww">wood</a></div></body></html>""",
    "Oak",
    "The oak is a tree of the beech family that can grow very old and feeds jays, squirrels and many others.",
    "Its wood is hard and was used for ships.",
)
page("empty frame", "<html><body><nav><a href=/>Home</a></nav><footer>&copy; 2020 Nobody</footer></body></html>")
page(
    "figure and code",
    """<html><body><header><nav><a href="/">Notes</a></nav></header><main id="main-content"><h1>Sorting by hand</h1><p>Few people sort cards the way a computer would, and there is a reason for it.</p><figure><img src=a.png><figcaption>Seven cards before the first step</figcaption></figure><p>Take the first card and put it where it belongs among those you already hold.</p><pre><code>for card in cards: insert(card)</code></pre></main><footer><p>Built by hand. <a href="/rss">RSS</a></p></footer></body></html>""",
    "Sorting by hand",
    "Few people sort cards the way a computer would, and there is a reason for it.",
    "Seven cards before the first step",
    "Take the first card and put it where it belongs among those you already hold.",
    "for card in cards: insert(card)",
)
page(
    "sidebar first",
    """<html><body><div id="container"><div id="leftnav"><h4>Topics</h4><ul><li><a href="/1">Bees</a></li><li><a href="/2">Honey</a></li><li><a href="/3">Hives</a></li></ul><p>Search this site</p></div><div id="maincontent"><h2>Why bees swarm</h2><p>A colony swarms when the hive has become too small for it, most often in May.</p><p>The old queen leaves with half of the bees, and a young one takes her place.</p></div></div></body></html>""",
    "Why bees swarm",
    "A colony swarms when the hive has become too small for it, most often in May.",
    "The old queen leaves with half of the bees, and a young one takes her place.",
)

# A second set, written after the first came out right. Three of its 99 blocks were wrong then: a title that is a link, an
# advert named in German, and the one that still is. The first two led to more layouts and names in training.
WRONG = {"amp news"}
page("medium-like","""<html><body><div id="root"><nav class="ab cd"><div><a href="/">Logo</a></div><div><a href="/signin">Sign in</a></div></nav><main><div class="ae"><article><div class="section"><h1 class="pw">Why I stopped using a calendar</h1><h2 class="sub">A year without appointments</h2><p class="pw-body">It started when my phone fell into the sea.</p><p class="pw-body">For three weeks I had no idea what day it was, and nobody seemed to mind.</p><figure><figcaption>The beach in question</figcaption></figure><blockquote>Time is what prevents everything from happening at once.</blockquote></div></article></div></main><div class="footer"><a href="/about">About</a><a href="/help">Help</a><a href="/legal">Legal</a></div></div></body></html>""",
"Why I stopped using a calendar","A year without appointments","It started when my phone fell into the sea.","For three weeks I had no idea what day it was, and nobody seemed to mind.","The beach in question","Time is what prevents everything from happening at once.")
page("gov form","""<html><body><div class="skip"><a href="#main">Skip to content</a></div><div role="banner"><p>Official site of the county</p></div><div role="navigation"><ul><li><a>Taxes</a></li><li><a>Roads</a></li></ul></div><div role="main" id="main"><h1>Renew a fishing permit</h1><p>You need a permit to fish in any lake of the county.</p><p>Permits are valid for one year from the day of issue.</p><form><label>Permit number</label><input><button>Renew</button></form></div><div role="contentinfo"><p>Contact us | Accessibility | Privacy</p></div></body></html>""",
"Renew a fishing permit","You need a permit to fish in any lake of the county.","Permits are valid for one year from the day of issue.")
page("blogger","""<html><body><div class="header section" id="header"><h1 class="title"><a href="/">Salt and Bread</a></h1><p class="description">Notes from a small kitchen</p></div><div class="main section" id="main"><div class="post hentry"><h3 class="post-title entry-title"><a href="/p">Rye loaf, again</a></h3><div class="post-body entry-content"><p>The dough was wetter than last week, and I let it rise overnight.</p><p>It came out flat but tasted of malt and honey.</p></div><div class="post-footer">Posted by Eva at <a href="/p">10:12</a> <a href="/c">3 comments:</a></div></div></div><div class="sidebar section" id="sidebar"><div class="widget BlogArchive"><h2>Blog Archive</h2><ul><li><a href="/2019">2019</a></li><li><a href="/2018">2018</a></li></ul></div><div class="widget Profile"><h2>About Me</h2><p>I bake bread and write about it.</p></div></div></body></html>""",
"Rye loaf, again","The dough was wetter than last week, and I let it rise overnight.","It came out flat but tasted of malt and honey.")
page("amp news","""<!doctype html><html amp><head><title>x</title></head><body><amp-sidebar><ul><li><a href=/>Front</a></li><li><a href=/b>Business</a></li></ul></amp-sidebar><article class="amp-wp-article"><header class="amp-wp-article-header"><h1>Harbour ferry returns after winter break</h1></header><div class="amp-wp-article-content"><p>The harbour ferry will run again from the first of March, two weeks earlier than last year.</p><amp-ad>Ad</amp-ad><p>Tickets cost the same as before.</p></div></article><footer class="amp-wp-footer"><p>Harbour Post</p><a href="#top">Back to top</a></footer></body></html>""",
"Harbour ferry returns after winter break","The harbour ferry will run again from the first of March, two weeks earlier than last year.","Tickets cost the same as before.")
page("readme","""<html><body><header class="Header"><a href="/">Hub</a><input placeholder=Search></header><div class="repohead"><h1><a href="/u">user</a>/<a href="/u/r">tool</a></h1><ul class="pagehead-actions"><li><a>Watch</a></li><li><a>Star</a></li></ul></div><div class="Box"><div class="markdown-body"><h1>tool</h1><p>A small tool that renames files by their content.</p><h2>Install</h2><pre>pip install tool</pre><h2>Usage</h2><p>Run it in a folder and answer its questions.</p><ul><li>It never deletes anything.</li><li>It keeps a log of all changes.</li></ul></div></div><div class="footer container"><ul><li><a>Terms</a></li><li><a>Status</a></li></ul></div></body></html>""",
"tool","A small tool that renames files by their content.","Install","pip install tool","Usage","Run it in a folder and answer its questions.","It never deletes anything.","It keeps a log of all changes.")
page("german portal","""<html lang=de><body><div id="kopf"><a href="/">Startseite</a> <a href="/wetter">Wetter</a></div><div id="inhalt"><h1>Neue Brücke eröffnet</h1><p class="vorspann">Nach vier Jahren Bauzeit ist die neue Brücke über den Fluss seit heute für den Verkehr frei.</p><p>Die alte Brücke wird im Herbst abgerissen, wie die Stadt mitteilte.</p><div class="anzeige">Anzeige</div><p>Radfahrer bekommen eigene Spuren.</p></div><div id="rechts"><h3>Meistgelesen</h3><ol><li><a href="/1">Stau am Morgen</a></li><li><a href="/2">Bäckerei schließt</a></li></ol></div><div id="fuss">Impressum Datenschutz</div></body></html>""",
"Neue Brücke eröffnet","Nach vier Jahren Bauzeit ist die neue Brücke über den Fluss seit heute für den Verkehr frei.","Die alte Brücke wird im Herbst abgerissen, wie die Stadt mitteilte.","Radfahrer bekommen eigene Spuren.")
page("press release","""<html><body><table class="layout"><tr><td class="logo">ACME Corp</td></tr><tr><td class="left"><a href="/n">News</a><br><a href="/i">Investors</a></td><td class="body"><h2>ACME opens plant in Norway</h2><p><b>OSLO, May 3</b> - ACME Corp opened a new plant near Oslo today that will make anvils for the whole of Europe.</p><p>The plant employs two hundred people.</p><p>About ACME: ACME has made anvils since 1920.</p></td></tr><tr><td colspan=2 class="foot">Copyright ACME Corp. All rights reserved.</td></tr></table></body></html>""",
"ACME opens plant in Norway","OSLO, May 3 - ACME Corp opened a new plant near Oslo today that will make anvils for the whole of Europe.","The plant employs two hundred people.","About ACME: ACME has made anvils since 1920.")
page("paywall notice","""<html><body><header><nav><a>Home</a><a>Opinion</a></nav></header><main><h1>The price of milk</h1><p>Milk costs more in the city than on the farm where it comes from, and not only because of the road between them.</p><div class="paywall">Subscribe now to read all articles. Already a member? Login</div><p>Half of the price is made by the dairies.</p></main><footer>Terms of use</footer></body></html>""",
"The price of milk","Milk costs more in the city than on the farm where it comes from, and not only because of the road between them.","Half of the price is made by the dairies.")
page("faq","""<html><body><div class="nav"><a>Home</a> <a>Contact</a></div><div class="faq"><h1>Questions</h1><dl><dt>When are you open?</dt><dd>Every day but Monday, from ten in the morning until six.</dd><dt>May I bring my dog?</dt><dd>Yes, on a lead.</dd></dl></div><div class="foot">Museum of Keys</div></body></html>""",
"Questions","When are you open?","Every day but Monday, from ten in the morning until six.","May I bring my dog?","Yes, on a lead.")
page("two line poem","""<html><body><h1>Fog</h1><p>The fog comes in at night<br>and leaves before the light.</p><p><a href="index.html">Index</a></p></body></html>""",
"Fog","The fog comes in at night and leaves before the light.")
page("long comments","""<html><body><div class="site"><div class="post"><h2>Short note</h2><p>The shop is closed on Friday.</p></div><div id="comments"><h3>Comments</h3><div class="comment"><p>What a pity, I wanted to come by on Friday with my whole family to look at the new lamps you wrote about.</p></div><div class="comment"><p>Will you be open on Saturday then? I live quite far away and would not like to make the trip for nothing.</p></div></div></div></body></html>""",
"Short note","The shop is closed on Friday.")
page("schema article","""<html><body><div class="container"><div class="row"><div class="col-md-8" itemscope itemtype="Article"><h1 itemprop="headline">Snails at work</h1><div itemprop="articleBody"><p>Snails cross the path at night and are gone by morning, which is why few people know how many there are.</p><p>We counted them for a month.</p><table><tr><th>Week</th><th>Snails</th></tr><tr><td>1</td><td>212</td></tr></table></div></div><div class="col-md-4"><div class="panel"><div class="panel-heading">Tags</div><div class="panel-body"><a>garden</a> <a>animals</a></div></div></div></div></div></body></html>""",
"Snails at work","Snails cross the path at night and are gone by morning, which is why few people know how many there are.","We counted them for a month.","Week","Snails","1","212")
