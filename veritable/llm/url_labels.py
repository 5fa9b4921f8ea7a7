"""Hand-labelled URLs: what a crawl for a training corpus should leave out, and what it should keep.

One URL a line. Hosts are under names that are reserved for examples and tests, or invented.
"""

from __future__ import annotations

UNWANTED = """
https://royal-slots.test/welcome-bonus
http://www.jackpot-palace.test/en/roulette?ref=9
https://play.bet365days.test/live/odds
https://blackjack-online.test/rules.html
https://pokerstarsclub.test/freeroll/77
http://m.luckyspin.test/spins/free
https://bingo-bonanza.test/uk/offers
https://sportsbet.test/football/odds/12
http://casinoroyale.test/de/slots
https://www.megaslots777.test/
https://baccarat.test/high-roller
https://lotto-winner.test/claim-prize
http://lottery-results.test/you-won
https://crypto-dice.test/bet/double
https://gambling-hub.test/top-10-casinos
https://vipbets.test/tips/sure-win
https://genericviagra.test/buy-now
http://www.cialis-shop.test/en/order
https://online-pharmacy.test/no-prescription/tramadol
https://buy-xanax.test/cheap
https://pharma-discount.test/pills/weight-loss
http://dietpills.test/lose-20kg
https://anabolic-steroids.test/shop
https://keto-miracle.test/free-trial
https://male-enhancement.test/results
https://canadianpharmacy.test/viagra/100mg
http://phentermine.test/online
https://hotgirls.test/cams/live
https://www.xxxvideos.test/watch/8731
http://pornbay.test/en/amateur
https://sexcams.test/chat
https://adultfriends.test/dating/hookup
http://escorts-city.test/vip
https://nude-gallery.test/page/3
https://milfhub.test/video/553
https://hentaiworld.test/read/12
https://erotic-stories.test/story/91
http://www.livesex.test/
https://fetishclub.test/members
https://18plus.test/enter
https://onlyhot.test/leaks/download
https://warezforum.test/full-version/cracked
http://keygen-center.test/photoshop-crack
https://torrentz.test/download/movie-2023-1080p
https://free-serials.test/activation-key
https://moddedapk.test/unlimited-coins
https://nulled-scripts.test/wp-theme
http://www.crackedgames.test/pc/iso
https://streamfree.test/watch-online-hd
https://putlocker.test/series/s01e02
https://ripmp3.test/album-download
https://emulator-roms.test/download/all
https://payday-loans.test/apply-now
http://instant-cash.test/bad-credit-ok
https://quick-loan.test/approval-in-minutes
https://debt-relief.test/consolidation-offer
https://forex-robot.test/guaranteed-profit
https://binary-options.test/signals
http://bitcoin-doubler.test/invest
https://earnmoneyfast.test/work-from-home
https://get-rich.test/secret-system
https://ponzi-plan.test/join/referral
https://cashback-survey.test/win-gift-card
http://free-iphone.test/claim
https://gift-cards.test/generator
https://prize-draw.test/congratulations/visitor
https://replica-watches.test/rolex
http://www.fakebags.test/louis-vuitton-outlet
https://cheap-nike.test/shoes-outlet
https://jerseys-wholesale.test/nfl
https://rayban-sale.test/90-off
https://designer-replica.test/handbags
http://uggboots.test/clearance
https://essaywriters.test/buy-essay
https://paper-mill.test/order-thesis
https://fake-diploma.test/degrees
https://buyfollowers.test/instagram/10k
https://seo-backlinks.test/buy-links
http://linkfarm.test/dir/submit
https://article-spinner.test/output/553
https://autoblog.test/scraped/post-9981
https://traffic-exchange.test/surf
https://clickbank-offers.test/hop/aff123
http://popunder.test/ad/click?cid=88
https://adserver.test/track/pixel.gif
https://redirect-me.test/out?u=aHR0cDov
https://doorway-pages.test/keyword/cheap-flights
http://parked-domain.test/?q=buy+this+domain
https://login-verify.test/paypal/secure/update
http://account-suspended.test/bank/confirm
https://apple-id-locked.test/signin
https://security-alert.test/virus-found
http://flash-update.test/install.exe
https://driver-booster.test/setup/download.exe
https://pc-cleaner.test/scan-now
https://tech-support.test/call-now
http://ransom-tools.test/decrypt
https://hack-wifi.test/password
https://spy-phone.test/track-partner
https://mass-mailer.test/spam-tool
https://proxy-list.test/unblock
http://psychic-reading.test/free-call
https://love-spells.test/bring-back-lover
https://horoscope-spam.test/today/leo?pop=1
https://celebrity-leaks.test/shocking
https://you-wont-believe.test/trick
http://miracle-cure.test/doctors-hate
https://hair-loss.test/one-weird-trick
https://russian-brides.test/catalog
https://sugar-daddy.test/dating
https://mail-order.test/brides
https://vape-discount.test/cbd-gummies
http://weed-shop.test/delivery
https://magic-mushrooms.test/buy
https://guns-online.test/no-license
https://darkmarket.test/vendor/cards
https://ccdumps.test/fullz
https://fake-id.test/scannable
https://coupon-codes.test/click/9912
http://dailydeals.test/promo?aff=41
https://mlm-success.test/opportunity
https://www.casino-royal.test/en/12
http://casino.test/de/88.html
https://m.casinobonus.test/fr/7
https://blog.casinotips.test/en/340?utm_source=feed
https://www.bet-now.test/es/5
http://bets.test/en/41/
https://m.live-bets.test/de/9
https://www.betting.test/fr/77#top
https://poker.test/en/3
https://www.slots.test/de/19.html
https://m.free-slots.test/en/6
https://www.buypills.test/en/21
https://pills.test/fr/4
http://www.discount-pills.test/de/12?page=2
https://cheapmeds.test/es/8
https://cheap-viagra.test/en/9
https://blog.cheap-tickets-scam.test/en/2
https://www.free-money.test/en/31
https://free-spins.test/es/17
https://m.free-porn.test/fr/1
https://www.xxx.test/en/10
https://sex.test/de/2
https://www.spammer.test/en/4
https://spam.test/fr/61
https://spam-network.test/en/7
http://www.link-farm.test/de/3
https://content-farm.test/en/55?utm_source=feed
https://www.ads.test/en/9
https://ads-network.test/de/14
https://m.adclick.test/en/3
https://click-ads.test/es/2
https://www.tracker.test/en/6
https://track-clicks.test/fr/33
https://www.win-prize.test/en/8
https://win-big.test/de/1
https://m.winner.test/es/40
https://www.loans.test/en/2
https://fast-loans.test/de/71
https://www.replica-shop.test/en/90/
https://warez.test/en/12
https://www.torrents.test/fr/6
https://crack.test/de/5
"""

WANTED = """
https://www.riverside-library.test/catalog/novels
https://history.museum.test/exhibits/bronze-age
http://townhall.test/council/minutes/2021-04.html
https://physics.university.test/courses/101
https://www.stmary-school.test/news/open-day
https://docs.parser.test/en/latest/tutorial.html
https://blog.kitchengarden.test/2019/05/tomatoes
https://wiki.astronomy.test/Comet
http://weather.test/forecast/berlin
https://www.citynews.test/local/bridge-repairs
https://journal.biology.test/article/4421
https://forum.woodworking.test/t/dovetail-joints/88
https://recipes.test/soups/lentil
https://trains.test/timetable/north
https://www.hikingclub.test/routes/ridge-walk
https://orchestra.test/season/programme
http://chess.test/openings/sicilian
https://birds.test/species/wren
https://geology.test/rocks/basalt
https://gardening.test/roses/pruning
https://poetry.test/poems/autumn
https://www.letters-archive.test/1914/06
https://dictionary.test/word/meander
https://languages.test/fr/grammaire
https://parliament.test/bills/2020/14
https://law.test/cases/appeal-77
https://statistics.test/population/regions
https://health.test/vaccines/schedule
https://hospital.test/visitors
http://www.dentists.test/advice/children
https://chemistry.test/elements/iron
https://math.test/proofs/pythagoras
https://software.test/release-notes/3.2
https://api.maps.test/reference/layers
https://opensource.test/projects/editor
https://linux.test/man/ls.1.html
https://community.test/questions/1123
https://mailinglist.test/archive/2009/msg00412.html
https://www.farmers.test/harvest/wheat
https://fishing.test/rivers/trout
https://sailing.test/knots
https://cycling.test/tours/alps
https://football-club.test/fixtures
https://running.test/marathon/training
https://tennis.test/results/2018
https://theatre.test/plays/hamlet
https://film.test/reviews/silent-era
https://painting.test/artists/dutch
https://photography.test/guides/aperture
https://architecture.test/bridges/arch
https://music.test/theory/scales
https://choir.test/concerts
https://travel.test/guides/lisbon
https://hotels.test/lisbon/old-town
https://airport.test/arrivals
https://ferries.test/harbour
https://bakery.test/bread/rye
https://cheese.test/varieties
https://wine.test/regions/mosel
https://coffee.test/brewing
https://economics.test/papers/inflation
https://bank.test/annual-report
https://insurance.test/faq
https://jobs.test/engineer
https://startup.test/about
https://charity.test/volunteer
https://church.test/services
https://temple.test/festival
https://philosophy.test/texts/ethics
https://psychology.test/memory
https://sociology.test/surveys/housing
https://newspaper.test/2003/07/14/editorial
https://magazine.test/issues/12
https://radio.test/podcast/episode-40
https://gazette.test/notices
https://press.test/release/opening
https://www.thelder.test/en/12
https://blog.anderin.test/fr/340
https://www.ontire.test/de/7.html
https://theren.test/es/51/
https://erandal.test/en/900?utm_source=feed
https://www.hathor.test/it/33#top
https://blog.neshe.test/en/218/
http://www.ndering.test/de/64?page=2
https://tinore.test/en/77
https://inthra.test/fr/5
https://www.ouanne.test/fr/99.html
https://blog.eurelle.test/fr/1003
https://schenung.test/de/412
https://www.undter.test/de/8/
https://ionmar.test/es/61?page=3&ref=x
https://www.adores.test/es/702#top
https://blog.shondo.test/en/15
http://arthen.test/en/660.html
https://www.restow.test/en/31?utm_source=feed
https://ghtly.test/en/58
https://www.thwhan.test/en/402
https://ndsth.test/de/19
https://blog.rtthe.test/es/77/
https://www.example.test/
https://example.test/index.html
https://www.sample-site.test/en/1
https://my-site.test/post/44
https://small-town.test/history
https://old-mill.test/visit
https://north-coast.test/walks
https://green-valley.test/school
https://free-school.test/lessons
https://best-practice.test/nursing
https://free-software.test/licence
https://online-course.test/algebra
https://home-cooking.test/stew
https://local-history.test/market-square
https://open-data.test/datasets/rainfall
https://book-club.test/reading-list
https://night-sky.test/planets
https://stone-age.test/tools
https://fair-trade.test/coffee
https://second-hand.test/books
https://young-farmers.test/events
http://ships.test/harbours
https://m.weather.test/en/4
https://m.trains.test/de/61
https://press.library.test/opening
https://mountains.test/walks
https://mill.test/visit
https://trade.test/history
https://chess-club.test/openings
https://silent-film.test/reviews
https://senate.test/bills/7
https://bridge.test/en/12
https://rivers.test/en/8
https://www.forest.test/de/3
https://oak-hill.test/en/6
https://sand-beach.test/fr/2
https://blue-river.test/es/9
https://m.thantor.test/en/31
https://m.oneshe.test/de/7
https://thessa.test/fr/19
https://www.tharren.test/de/44
https://athend.test/de/5
https://ththor.test/en/91
https://www.rederth.test/es/3
https://tirand.test/en/5
https://blog.leyath.test/de/330
https://www.wather.test/fr/8
https://restha.test/de/120
https://farm.test/en/5
https://www.dairy-farm.test/visit
https://apple-farm.test/harvest
https://railway-track.test/history
https://running-track.test/opening-hours
https://market.test/en/9
https://www.fish-market.test/de/1
https://freedom.test/essays
https://winter.test/en/2
https://windmill.test/fr/6
https://better-sleep.test/advice
https://alphabet.test/letters
https://essex.test/towns
https://middlesex.test/history
"""

