"""The small labelled table of the URL filter: host/path, allowed or blocked.

Allowed ones are ordinary pages of encyclopedias, universities, news, documentation,
shops, public offices and private sites, some with words that blocked pages use
in another sense; blocked ones are adult, gambling, drugs, piracy, phishing,
advertising and spam pages.  A caller may pass a table of its own.
"""

from __future__ import annotations

ALLOWED = tuple("""
en.wikipedia.org/wiki/Photosynthesis en.wikipedia.org/wiki/Sex_education en.wikipedia.org/wiki/Casino_Royale_(novel)
de.wikipedia.org/wiki/Bank fr.wikipedia.org/wiki/Poker es.wikipedia.org/wiki/Historia en.wikipedia.org/wiki/Cialis
www.sussex.ac.uk/history www.essex.ac.uk/departments/law middlesex.edu/courses www.ox.ac.uk/research/medical
www.cam.ac.uk/news/study-finds mit.edu/education/ocw web.stanford.edu/class/cs224n www.tum.de/studium
www.sorbonne-universite.fr/formation www.uam.es/investigacion arxiv.org/abs/1706.03762 www.nature.com/articles/s41586
www.science.org/doi/10.1126 journals.plos.org/plosone/article pubmed.ncbi.nlm.nih.gov/31452104
docs.python.org/3/library/re.html developer.mozilla.org/en-US/docs/Web/HTML spark.apache.org/docs/latest/sql-ref.html
github.com/apache/spark/blob/master/README.md stackoverflow.com/questions/11227809 www.w3.org/TR/html52
kernel.org/doc/html/latest go.dev/doc/effective_go doc.rust-lang.org/book/ch04 www.postgresql.org/docs/current/tutorial
www.bbc.co.uk/news/science-environment www.theguardian.com/world/2019/report www.nytimes.com/2020/01/05/books/review
www.lemonde.fr/sciences/article/2020 www.spiegel.de/wissenschaft/artikel elpais.com/ciencia/2022-01-10/articulo
www.reuters.com/business/banks apnews.com/article/health www.zeit.de/kultur/literatur www.corriere.it/cronache/articolo
www.gov.uk/guidance/how-to-apply www.nhs.uk/conditions/erectile-dysfunction www.scunthorpe.gov.uk/council/services
www.irs.gov/forms-pubs europa.eu/youth/learning www.bundestag.de/dokumente www.service-public.fr/particuliers
www.weather.gov/forecast/today www.nasa.gov/missions/artemis www.who.int/news-room/fact-sheets www.un.org/en/about-us
www.britannica.com/topic/history www.gutenberg.org/ebooks/1342 archive.org/details/texts openlibrary.org/works/OL45804W
www.loc.gov/collections/maps www.louvre.fr/en/explore www.metmuseum.org/art/collection/search
www.allrecipes.com/recipe/bread/sourdough www.bonappetit.com/story/how-to-cook-rice www.seriouseats.com/guide/knives
www.lonelyplanet.com/portugal/lisbon www.nationalgeographic.com/animals/mammals/facts/fox www.imdb.com/title/tt0112641
www.goodreads.com/book/show/1885 letterboxd.com/film/casino www.rollingstone.com/music/album-reviews
www.ikea.com/us/en/p/bookcase www.etsy.com/listing/handmade-bag www.uniqlo.com/us/en/women/sweaters www.rolex.com/watches/submariner
www.visa.com/support/consumer www.chase.com/personal/checking www.paypal.com/us/home www.deutsche-bank.de/pk/konto
support.google.com/accounts/answer help.apple.com/iphone/settings www.mozilla.org/en-US/firefox/download
www.debian.org/distrib/netinst www.libreoffice.org/download www.videolan.org/vlc/index.html
medium.com/story/learning-to-read blog.rust-lang.org/2023/release janesgarden.blog/tomatoes-in-june travelswithanna.net/peru/hiking
familyrecipes.info/soups/lentil chessclub.org/opening/sicilian runningforum.net/thread/1204 birdwatching.me/notes/heron
quiltersguild.com/patterns/star mathclub.org/problems/geometry oldmaps.city/library/1890 localtheatre.co.uk/tickets/spring
www.fide.com/calendar/tournament www.uefa.com/champions/matches www.lego.com/en-us/kids www.pbs.org/parents/reading
careers.siemens.com/jobs/engineer riverside-vet.com/pets/vaccines cityofboise.org/meetings/minutes
www.cancer.org/treatment/drugs forum.gardeners.net/thread/88 news.localpaper.info/2021/school notes.smallcompany.net/fr/produits
shop.bookstore.net/en/novels www.school-essex.net/fr/cours pharmacy.umich.edu/programs www.drugs.com/mtm/aspirin.html
""".split())

BLOCKED = tuple("""
ads.mediabuy.com/banner/click adserver.trackmedia.net/pixel/track.gif ads.bigmedia.com/banner/300x250 cdn.adnxs-track.net/pixel
click.tracker-ads.com/redirect/banner popunder.adnetwork.biz/pop/click doubleclick.adhost.net/ads/impression pixel.adtrack.net/collect/impression
banner.adexchange.top/serve/ad track.clickserve.biz/redirect/aff adclick.popcash.net/pop/under stats.ad-tracker.info/beacon/pixel
casino-bonus.bet/free-spins win.jackpot-casino.com/play/slots poker-online.bet/bonus/casino betting-odds.bet/win/bonus
online-slots-casino.top/free/spins best-casino-bonus.xyz/roulette/play sportbet-bonus.win/odds/live megaslots.casino/jackpot/free
royal-poker-bonus.club/signup/bonus bet-casino-live.top/blackjack luckyspins.bet/slots/bonus vegas-jackpots.win/casino/play
cheap-pills.biz/buy/viagra pharmacy-discount.biz/order/pills buy-viagra-online.top/cheap/cialis cheap-meds.shop/order/tramadol
no-prescription-pills.xyz/buy/xanax online-pharmacy-cheap.biz/viagra/order genericviagra.top/buy/now diet-pills-cheap.shop/order
xxx-adult.tube/videos/hot live-sex.cam/girls adult-porn.xxx/gallery hotporn.tube/free/videos xxxcams.live/girls/hot
adult-videos.net/categories adult-stories.blog/read/4 free-porn-videos.xxx/hot/teen nude-girls.cam/live/sex sexchat.date/girls/nude escort-girls.date/hot/adult dating-hookup.date/sex/now
adult-webcam.xxx/live/nude milf-porn.tube/xxx/videos escorts-vip.club/girls/tonight hookup-tonight.xyz/adult/dating
free-download-crack.ru/keygen/serial warez.top/crack/full-version crackedsoft.ru/download/keygen full-cracked-apps.top/serial/activation
torrent-free.to/download/movie streaming-free-movies.to/watch/hd piratemovies.to/free/torrent watch-free-hd.ru/movie/streaming
nulled-scripts.top/download/cracked keygen-serials.ru/windows/activator freemp3-warez.top/download/album torrents-hub.to/movie/1080p
login-verify-account.tk/secure/update paypal-secure-login.xyz/verify/account bank-security-update.ml/login/verify
phish.bank-login.tk/account/verify appleid-verify.ga/login/secure secure-account-update.cf/paypal/login amazon-verify.tk/account/locked
netflix-billing-update.ml/login/verify wallet-verify.xyz/seed/confirm microsoft-alert.tk/support/locked dhl-parcel-fee.top/pay/verify
chase-secure-login.gq/verify/account mail-quota-update.ml/login/webmail irs-refund-claim.tk/verify/ssn
get-rich-quick.loan/bitcoin/profit crypto-doubler.top/invest/profit forex-bonus.bid/signup/win bitcoin-profit-now.xyz/invest/double
loan-payday.loan/apply/fast payday-cash.loan/credit/instant instant-loan-approval.loan/apply/now fast-cash.loan/bad-credit
lottery-winner.win/claim/prize prize-claim.click/winner/iphone free-iphone-winner.top/claim/now gift-card-free.click/claim/prize
replica-watches.shop/cheap/rolex outlet-cheap-bags.shop/sale/discount fake-rolex.shop/replica/cheap cheap-jerseys.top/outlet/sale
spamlink.click/go/affiliate affiliate.clickbank-deals.biz/hop/redirect seo-backlinks.biz/buy/links buy-followers.top/instagram/cheap
cheap-likes.click/buy/followers traffic-bot.biz/buy/visitors miracle-diet.shop/lose/weight/pills weight-loss-secret.top/buy/keto
malware-host.ru/exe/setup.exe free-antivirus-scan.top/download/setup.exe driver-update.xyz/install/setup.exe flash-player-update.ml/download.exe
""".split())

LABELLED = tuple((u, 0) for u in ALLOWED) + tuple((u, 1) for u in BLOCKED)
