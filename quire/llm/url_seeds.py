"""A small labelled URL table: fixed values, label 1 = block.  Replace it by your own."""

# Hand-labelled example URLs.
BLOCK = """
https://casino-royal.test/slots/free-spins
https://www.best-casino.test/poker/jackpot
http://win-casino.test/bonus.html
https://m.lucky-win.test/win/1029
https://bet-online.test/odds/football
https://www.free-bets.test/tips
http://sports-betting.test/bets/today
https://cheap-pills.test/order/viagra
https://www.online-pharmacy-pills.test/cheap/no-prescription
http://buy-cheap-meds.test/pills.html
https://diet-pills.test/weight-loss
https://adult-video.test/xxx/clip-22
https://www.adult-x.test/live
http://xxx-cams.test/adult/girls
https://sexy-chat.test/porn/index.html
https://hot-porn.test/watch?v=9
https://spam-mail.test/unsubscribe
http://spam-farm.test/links/77
https://www.link-farm.test/seo/backlinks
https://content-farm.test/top-10-tricks
https://ads-server.test/banner/300x250
http://track-click.test/pixel.gif
https://www.ads-track.test/click?id=4
https://popup-ads.test/ad/track
https://click-tracker.test/redirect/ads
http://payday-loans.test/cheap/instant-cash
https://get-rich-quick.test/bitcoin/doubler
https://free-iphone-win.test/prize/claim
https://replica-watches.test/cheap/rolex
http://torrent-crack.test/free-download/keygen
https://warez-crack.test/serial
https://blog.casino-bets.test/free
https://m.cheap-viagra.test/pills
http://blog.adult-spam.test/x
https://free-casino.test/win
http://www.free-porn.test/adult
https://casino-win.test/en/4417.html
http://m.casino-bonus.test/de/212
https://adult-x.test/fr/9120?utm_source=feed
http://www.adult-dating.test/es/77
https://spam-farm.test/en/3105/
https://blog.spam-links.test/fr/18
https://ads-track.test/de/5512#top
http://m.ads-network.test/en/8
https://free-bets.test/en/661?page=2
https://www.sure-bets.test/es/1934.html
https://cheap-pills.test/en/7208
http://blog.pills-shop.test/de/43
https://pills-online.test/en/buy
http://pills4you.test/fr/118.html
https://www.herbal-pills.test/es/6
https://casino.test/en/play
http://bets.test/fr/live
https://adult.test/de/18
"""
ALLOW = """
https://www.city-library.test/catalogue/authors
https://news.daily-herald.test/en/2021/politics
http://blog.garden-notes.test/de/rosen
https://en.encyclopedia.test/wiki/Photosynthesis
https://www.university.test/fr/recherche
https://docs.compiler.test/reference/strings.html
http://weather.test/forecast/berlin
https://www.museum.test/es/exposiciones
https://m.recipes.test/soup/tomato
https://forum.bicycle.test/thread/1834
https://school.test/en/timetable
http://www.parliament.test/debates/5512
https://science.journal.test/articles/8871
https://open-data.test/tables/rainfall.csv
https://www.train-times.test/de/fahrplan
http://history.test/en/romans/7321
https://blog.mountain.test/fr/randonnee
https://software.test/download/manual.html
https://photo.test/landscape/42
https://www.theatre.test/programme
https://health.ministry.test/en/vaccines
http://city-council.test/minutes/2019
https://maps.test/en/route?from=a
https://music.test/albums/3310
https://the-reader.test/essays/there-and-then
https://m.the-other.test/en/4711
https://www.another-nation.test/en/2210
http://blog.station.test/fr/8123
https://www.then-and-there.test/en/9921.html
https://northern.test/de/4418
http://m.tenderness.test/es/1205
https://gathering.test/en/5120/
https://blog.weather-event.test/en/3340?page=2
https://www.brothers.test/en/8120
https://therapy.test/en/620
http://nation.test/en/1773#top
https://blog.mission.test/de/5534
https://blog.printable.test/en/98
https://orchestra.test/fr/212?utm_source=feed
https://heritage.test/es/3011
https://panther.test/de/18944.html
http://m.northland.test/fr/40212.html
https://www.together.test/en/33018.html
https://blog.another.test/es/2907.html
http://stationery.test/fr/16077/
https://m.leather.test/de/7311.html
https://www.whether.test/en/9034/
http://either.test/fr/38112?page=2
https://motherland.test/es/12001#top
https://www.threnody.test/de/19.html
http://strength.test/en/9.html
https://blog.entrance.test/fr/29.html
https://m.transit.test/es/5.html
http://www.hundred.test/de/109.html
https://children.test/en/89.html
https://sunday-market.test/index.html
http://theorem.test/de/39.html
https://www.renters.test/fr/9.html
https://m.winter-theatre.test/en/49.html
https://freedom.test/en/61
http://www.betterment.test/de/7
"""


def seed_rows() -> list[tuple[str, int]]:
    return ([(u, 1) for u in BLOCK.split()] + [(u, 0) for u in ALLOW.split()])
