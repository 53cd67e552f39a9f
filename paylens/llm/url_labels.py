"""A small labelled table of URLs: made-up addresses that are worth keeping, and made-up ones that are not."""

KEEP = """
https://www.riverhouse.org/about
https://blog.riverhouse.org/2021/03/on-old-maps
http://news.oakfield.net/en/12873
https://oakfield.net/de/40112.html
https://m.oakfield.net/fr/9921
https://garden-notes.com/tomatoes/how-to-prune
https://www.garden-notes.com/en/7719/
https://library.northhill.edu/catalogue/maps
https://northhill.edu/en/30417?page=2
http://papers.northhill.edu/2019/algebra.html
https://docs.tinytools.io/guide/install
https://tinytools.io/blog/release-notes
https://www.tinytools.io/en/2250#top
https://kitchen.example.org/recipes/bread
https://kitchen.example.org/en/18222
http://www.harbourpost.co.uk/news/local/ferry-timetable
https://harbourpost.co.uk/en/60112?utm_source=feed
https://m.harbourpost.co.uk/sport/5521
https://museum.altstadt.de/sammlung/gemaelde
https://altstadt.de/de/31877
http://blog.altstadt.de/de/20991.html
https://www.villeneuve.fr/fr/10443
https://villeneuve.fr/actualites/marche-de-noel?page=2&ref=x
https://blog.villeneuve.fr/fr/45120/
https://casadelsol.es/es/8812
https://www.casadelsol.es/recetas/gazpacho
https://m.casadelsol.es/es/50771?utm_source=feed
https://wiki.smallstack.net/index.php?title=Queues
https://smallstack.net/questions/41822/how-do-i-sort-a-list
http://smallstack.net/en/17734?page=2&ref=x
https://forum.smallstack.net/t/4411
https://physics.lakeside.edu/courses/waves
https://lakeside.edu/en/26661.html
https://www.lakeside.edu/people/staff
http://radio.midtown.fm/programmes/morning
https://midtown.fm/en/33980#top
https://weather.midtown.fm/en/41290
https://handbook.builders.org/roof/tiles
https://builders.org/en/22917/
http://blog.builders.org/2018/11/measuring-twice
https://poems.oldpress.com/autumn
https://www.oldpress.com/en/2981.html
https://oldpress.com/en/11620?utm_source=feed
https://m.oldpress.com/de/37450
https://gov.northcounty.us/permits/fences
https://northcounty.us/en/48821
https://trains.example.com/timetable/north
https://example.net/es/26123?page=2&ref=x
https://blog.quietroom.net/essays/reading
https://quietroom.net/en/35332/
http://quietroom.net/fr/34463#top
https://chess.club/openings/italian-game
https://chess.club/en/5512
https://stories.paperboat.in/en/29012
https://www.paperboat.in/children/the-fox
http://paperboat.in/en/8123.html
https://health.fieldclinic.org/en/19440?page=2
https://fieldclinic.org/advice/colds
https://law.fieldclinic.org/en/27011
https://birds.wetlands.info/species/heron
https://wetlands.info/en/39118
http://www.wetlands.info/maps/north
"""

DROP = """
http://win-big-cash-777-now.xyz/claim?id=8837261&aff=9921&sub=3&src=pop&t=1699
https://free-prize-4u-9921.top/go.php?u=aHR0cDovL2V4YW1wbGU&k=773&c=12&z=9
http://a1b2c3d4e5f6a7b8.click/r/9f8e7d6c5b4a39281706f5e4d3c2b1a0
http://cheap-pills-0nline-24h.biz/buy/now/cart/add/item/99881/?ref=77&sid=abc123&promo=55
https://login-secure-update-account-verify.top/session/8a7s6d5f4g3h2j1k/confirm?token=9x8c7v6b5n4m
http://x9k2m4q7.xyz/?p=83726&q=19283&r=55512&s=99&t=7781&u=1
https://hot-deals-2024-sale-99.shop/products/cat/77/sub/881/item/99182/var/3?clickid=ab12cd34ef56
http://track.adclick-7721.click/c/8812/9912/7712/6612?cid=88127712&pid=991&aid=12&rid=7
https://casino-bonus-777-free-spins.top/en/register/step/1/2/3?aff_id=5521&click=a8b7c6d5
http://dl-crack-keygen-full.ru/files/2023/09/18/setup_v9.8.7.6_x64_patch.zip?dl=1&k=77123
https://q8w7e6r5t4y3.top/a8s7d6f5/z9x8c7v6/index.php?x=1&y=2&z=3&w=4&v=5
http://198.51.100.23/~user77/x/y/z/w/load.php?id=99817263554&k=8817
https://get-rich-fast-1000-per-day.info/land/7/8/9/?utm_id=88127&gclid=EAIaIQobChMI8f7e6d5c4b3a2
http://video-xx-hot-cams-live-4477.click/watch?v=99812&m=2281&pop=1&ref=8821&b=77
https://cdn77.traff1c-x8.xyz/redir/0a1b2c3d4e5f/60718293a4b5/?to=aHR0cHM6Ly9sYW5kaW5n&s=1&d=2
http://loan-approved-instant-5000-usd.biz/apply?amt=5000&t=12&id=71829&src=em&cmp=8812
https://m3d1c4l-st0re-77.shop/v14gr4/buy/100mg/30/pills/?disc=70&aff=8821&s=99
http://zz8812kk99.top/8812771/9927716/1827364/5546372.html
https://paste-dump-99.ru/raw/8f7e6d5c4b3a291807f6e5d4c3b2a190/dump_9981726354.txt
http://seo-links-cheap-10000.info/out.php?l=88271&p=19283&site=7&from=881&to=992
https://bit-c0in-doubler-24.xyz/invest?ref=0x8f7e6d5c4b3a29180716253443526170&amt=1
http://sweepstake-winner-id-8817263.click/confirm/8817263/now/?e=77&h=9a8b7c6d
https://n7x5c3v1.shop/p/99182736455463728190?sku=8817&ref=1827&tag=99&cmp=21&ad=3
http://warez-mirror-12.top/get/Movie.2024.1080p.x264-887/part01.rar?key=8817aa77bb66cc
https://survey-gift-card-500.xyz/s/1/q/2/q/3/q/4/end?uid=8817263549&aff=77&o=12&cr=9
http://k8k8k8-slot-online-88.biz/daftar?ref=88127&bonus=100&id=99817
https://push-notify-allow-77.click/?z=8817263&var=99182&ymid=a8b7c6d5e4f3&b=1&c=2
http://fast-torrent-9911.ru/t/88172635/dl/99182736/?h=1f2e3d4c5b6a79880716253443526170&tr=7
https://essay-writer-cheap-24-7.info/order/new/type/4/pages/12/?coupon=88AA77&aff=9912
http://y7u8i9o0p1.xyz/t5r4e3w2q1/8877665544332211/?a=0&b=9&c=8&d=7&e=6&f=5
https://pharma-direct-no-rx-77.top/item.php?cat=88&prod=7712&qty=90&mg=100&aff=81
http://203.0.113.77:8080/cgi-bin/x.cgi?cmd=88&arg=7712&sess=99182736455463728190
https://adserv-99.shop/imp?pid=8817&cid=2716&bid=0.0012&cb=1699887766554&w=300&h=250
http://dating-near-you-tonight-18.click/profile/8817263?src=pop&cmp=7712&zone=99182
https://8817263.xyz/99182736/index.html?1699887766554433
http://replica-watch-outlet-90off.biz/rolex-8817-gold-40mm-p-99182.html?zenid=8a7b6c5d4e3f2a1b0c9d
https://instant-followers-10k-5usd.top/buy/10000/?user=88172&token=77aa66bb55cc44dd33ee
http://hdfree-stream-2217.ru/embed/8a7b6c5d4e3f?autoplay=1&t=8817&sub=9&ref=77&ad=12&z=4
https://update-flash-player-now-77.xyz/dl/setup_8817263.exe?cid=99182736&s=5546
http://u2k9d8.click/e8d7c6b5a4938271/60f5e4d3c2b1a099?m=1&n=2&o=3&p=4
https://claim-tax-refund-secure-id.info/gov/login/step2/verify?case=8817263549&sid=aa11bb22cc33dd44
http://mega-coupon-777-offers.shop/c/88/17/26/35/49/?uid=7712&clk=99182736&n=5
https://v9b8n7m6.top/x/y/z/8817263549/7712/a/b/c/d/e/f/g/h.html
http://numbers-leak-2023.ru/db/8817263549_7712998.sql.gz?auth=5d4c3b2a19
https://bonus-forex-signal-99.biz/join?ib=88172&camp=7712&lp=3&lang=en&utm_content=99182736
http://w0w-g0ld-cheap-11.xyz/sell/server/88/gold/10000/?aff=7712&cur=usd&r=99182
https://ringtones-free-4u.click/d/8817263/7712/99/?msisdn=5546372819&op=12&k=8a7b6c
http://p0rn-tube-hd-7711.top/v/88172635/hot?pop=1&ref=9918273&z=77&s=12
https://jackpot-city-888.shop/play/88/17/26?tracker=99182736455&promo=77AA88BB
http://r5t6y7u8.info/out/?id=8817263549817263&url=aHR0cHM6Ly94eXouZXhhbXBsZQ&h=7712
"""

#: (url, whether it is to be dropped)
LABELLED = [(u, 0) for u in KEEP.split()] + [(u, 1) for u in DROP.split()]
